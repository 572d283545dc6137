"""The registered queries: one per operator, over the driver tables."""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tradeweave import operators as op
from tradeweave import sinks, sources
from tradeweave.functions import (
    indel_ratio,
    jaro_winkler,
    matches_like,
    matches_regex,
    price_similarity,
    price_to_number,
)
from tradeweave.plans import pipelines
from tradeweave.plans import views as v
from tradeweave.workspace import materialize, new_path

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

DRIVER_TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)
# The attributes of the mediated load and the assignment given by hand.
ATTRIBUTES = ("name", "category", "ratings", "discountprice", "actualprice", "imagelinks")
OVERRIDES = {"discountprice": ("reducedprice", "discount_price")}
COLUMN_THRESHOLD = 0.7
BEST_THRESHOLD = 0.85
STRICT = 0.9
# Image links count as equal above 0.6, the bound excluded.
IMAGE_RULE = op.Rule(math.nextafter(0.6, 1), 1.0, 0.0, name="link", price=None)
# The mediated load: attributes with their types, as its table holds them.
LOADED = sinks.Contract(
    types={
        "name": "string", "category": "string", "ratings": "double", "discountprice": "double",
        "actualprice": "double", "imagelinks": "string", "source": "string",
    }
)
BEST_OF = {
    "most_followed": ("profiles", "followers"),
    "top_a_profit": ("sales", "profit_in_a_percent"),
    "top_b_profit": ("sales", "profit_in_b_percent"),
}
PAIRS = 0.95
ITEM_QUERY = "small ring Brand#7"


def query(fn: Query) -> Query:
    QUERIES[fn.__name__.removesuffix("_query")] = fn
    return fn


# --- sources ---------------------------------------------------------------


@query
def scan_relational(spark, sf):
    return sources.read_relational(spark, f"{sf}/orders.parquet").select(
        "o_orderkey", "o_custkey", "o_totalprice"
    )


def _stored_documents(spark, sf):
    path = new_path(spark, "documents")
    v.documents_a(spark, sf).write.text(path)
    names = ["_id", "nameitem", "nameitems", *list(v.CATALOG_A)[2:]]
    schema = T.StructType([T.StructField(n, T.StringType()) for n in names])
    return sources.read_documents(spark, path, schema)


@query
def scan_document(spark, sf):
    return _stored_documents(spark, sf).select("_id", "nameitem", "nameitems", "reducedprice")


@query
def scan_drop_id(spark, sf):
    return sources.drop_id(v.catalog_a(spark, sf)).select("nameitem", "sub_category", "link")


@query
def scan_id_as_string(spark, sf):
    return sources.id_as_string(v.catalog_a(spark, sf)).select("_id", "nameitem")


@query
def global_view(spark, sf):
    return sources.branch_view(v.catalog_b(spark, sf), v.branches_b()).drop("branch")


@query
def global_view_keyed(spark, sf):
    view = sources.branch_view(v.catalog_b(spark, sf), v.branches_b())
    return sources.number_rows(view, v.KEYED_B, ["category", "name", "image_links"])


@query
def combined_view(spark, sf):
    drifted = {v.DRIFTED.lower(): {"nameitems": "nameitem"}}
    view = sources.branch_view(v.catalog_a(spark, sf), v.branches_a(), drifted, ["main_category"])
    return view.drop("branch")


RAW_ITEM = T.StructType(
    [
        T.StructField(n, T.StringType())
        for n in ("_id", "nameitem", "sub_category", "reducedprice", "actualprice")
    ]
)


def _raw_items(spark, sf):
    return v.catalog_a(spark, sf).select(
        F.col("_id").cast("string").alias("_id"),
        F.concat(F.lit("  "), "nameitem").alias("nameitem"),
        "sub_category",
        "reducedprice",
        "actualprice",
    )


@query
def ingest_csv_clean(spark, sf):
    path = new_path(spark, "csv")
    _raw_items(spark, sf).write.csv(path, header=True, escape='"')
    return sources.ingest_csv(
        spark, path, RAW_ITEM, ["nameitem", "sub_category"], ["reducedprice", "actualprice"]
    )


@query
def ingest_json_clean(spark, sf):
    path = new_path(spark, "json")
    _raw_items(spark, sf).write.json(path)
    return sources.ingest_json(
        spark, path, RAW_ITEM, ["nameitem", "sub_category"], ["reducedprice", "actualprice"]
    )


@query
def catalog_snapshot(spark, sf):
    tables = {t: f"SELECT * FROM parquet.`{sf}/{t}.parquet`" for t in DRIVER_TABLES}
    sources.register_source(spark, "driver", tables)
    return sources.catalog_snapshot(spark, ["driver"])


@query
def field_profile(spark, sf):
    return sources.field_profile(v.documents_a(spark, sf), "doc")


# --- sinks -----------------------------------------------------------------


@query
def sink_overwrite(spark, sf):
    path = new_path(spark, "overwrite")
    sinks.overwrite(v.mediated_b(spark, sf), path)
    sinks.overwrite(v.mediated_a(spark, sf), path)
    return spark.read.parquet(path)


@query
def sink_overwrite_many(spark, sf):
    parts = op.overlap_split(v.profiles(spark, sf), v.partnerships(spark, sf))
    paths = sinks.overwrite_many(parts, new_path(spark, "overlap"))
    loaded = {
        kind: spark.read.parquet(p).select(F.lit(kind).alias("output"), "*")
        for kind, p in paths.items()
    }
    return sources.combined_view(loaded, {})


@query
def sink_append(spark, sf):
    path = new_path(spark, "append")
    sinks.append(v.mediated_a(spark, sf), path)
    sinks.append(v.mediated_b(spark, sf), path)
    return spark.read.parquet(path)


@query
def sink_append_new_only(spark, sf):
    path = new_path(spark, "append-new")
    both = v.mediated_a(spark, sf).unionByName(v.mediated_b(spark, sf))
    sinks.append_new_only(both, _empty_table(both, path), both.columns)
    sinks.append_new_only(both, path, both.columns)
    return spark.read.parquet(path)


def _empty_table(df, path):
    sinks.overwrite(df.limit(0), path)
    return path


@query
def surrogate_key(spark, sf):
    ordered = ["discount_price", "name", "image_links"]
    return sinks.with_surrogate_key(
        v.catalog_b(spark, sf).select(*ordered), [F.desc("discount_price"), *ordered[1:]]
    )


@query
def coerce_to_contract(spark, sf):
    return sinks.coerce_to_contract(v.raw_mediated_a(spark, sf))


@query
def append_validated(spark, sf):
    path = new_path(spark, "validated")
    sinks.append_validated(v.raw_mediated_b(spark, sf), path)
    return spark.read.parquet(path)


NEW_PRODUCT = (
    "ECONOMY", "TIN WATERING CAN", 3.0, 12.75, 18.5, "Brand#77", 4.1,
    "holds six litres", "green, with a long spout", "garden/can.png",
)


@query
def insert_values(spark, sf):
    path = new_path(spark, "insert")
    products = v.catalog_b(spark, sf)
    sinks.overwrite(products, path)
    sources.register_source(spark, "loads", {"products": path})
    sinks.insert_values(products, "loads.products", [NEW_PRODUCT])
    return spark.table("loads.products")


@query
def write_with_count(spark, sf):
    path = new_path(spark, "counted")
    written = sinks.write_with_count(v.mediated_a(spark, sf), path)
    return spark.read.parquet(path).agg(
        F.lit(written).cast("bigint").alias("n_reported"), F.count(F.lit(1)).alias("n_found")
    )


# --- projection and predicates ---------------------------------------------


@query
def project(spark, sf):
    return v.profiles(spark, sf).select("user_name", "followers")


@query
def project_star(spark, sf):
    return v.profiles(spark, sf).select("*")


@query
def project_alias(spark, sf):
    return v.catalog_a(spark, sf).select(
        F.col("nameitem").alias("name"), F.col("reducedprice").alias("discount_price")
    )


@query
def project_available(spark, sf):
    return op.select_available(
        v.catalog_a(spark, sf), ["nameitem", "seller_name", "link", "followers"]
    )


@query
def project_mapped(spark, sf):
    return op.select_mapped(v.catalog_a(spark, sf), v.A_TO_MEDIATED)


@query
def render_text(spark, sf):
    return op.render_text(v.table(spark, sf, "customer"))


@query
def render_json(spark, sf):
    return op.render_json(v.table(spark, sf, "labels"))


@query
def source_tag(spark, sf):
    return v.raw_mediated_b(spark, sf)


@query
def like_ci(spark, sf):
    return v.catalog_b(spark, sf).where(matches_like("name", "%Ring%")).select("name", "image_links")


@query
def like_prefix(spark, sf):
    return v.catalog_b(spark, sf).where(matches_like("name", "small%")).select("name", "image_links")


@query
def like_bare_word(spark, sf):
    return v.catalog_b(spark, sf).where(matches_like("name", "gear")).select("name", "image_links")


@query
def regex_ci(spark, sf):
    return (
        v.table(spark, sf, "documents")
        .where(matches_regex("text", "%LICEN[SC]E%"))
        .select("doc_id", "lang")
    )


@query
def filter_gt(spark, sf):
    return (
        v.table(spark, sf, "lineitem")
        .where(F.col("l_extendedprice") > 90000)
        .select("l_orderkey", "l_linenumber", "l_extendedprice")
    )


@query
def filter_eq(spark, sf):
    return (
        v.partnerships(spark, sf)
        .where(F.col("business_category") == "Standard")
        .select("username", "company_name", "product")
    )


@query
def having_avg(spark, sf):
    return (
        v.catalog_b(spark, sf)
        .groupBy("name")
        .agg(F.avg("discount_price").alias("avg_price"))
        .where(F.col("avg_price") > 2500)
        .select("name", F.round("avg_price", 9).alias("avg_price"))
    )


@query
def having_sum(spark, sf):
    return (
        v.table(spark, sf, "lineitem")
        .groupBy("l_suppkey")
        .agg(F.sum("l_quantity").alias("sum_quantity"), F.count(F.lit(1)).alias("count"))
        .where(F.col("sum_quantity") > 15000)
    )


@query
def drop_null_rows(spark, sf):
    return op.drop_null_rows(v.catalog_a(spark, sf).select("_id", "nameitem", "reducedprice"))


@query
def quarantine_bad_price(spark, sf):
    good, bad = sinks.quarantine(v.raw_mediated_a(spark, sf))
    kept = [
        df.select(
            F.lit(status).alias("status"), "name", "category", F.col("ratings").cast("double").alias("ratings")
        )
        for status, df in (("loaded", good), ("rejected", bad))
    ]
    return sources.global_view(kept)


# --- joins -----------------------------------------------------------------


@query
def lookup_nested(spark, sf):
    """Nested by chunks of the partnership's id, then every nested row in full."""
    nested = op.lookup_nested(v.profiles(spark, sf), v.partnerships(spark, sf), deal=F.col("_id"))
    nested = nested.select(
        F.col("_id").alias("profile_id"),
        "user_name",
        "chunk",
        F.size("matched").alias("n_matched"),
        F.explode_outer("matched").alias("match"),
    )
    return nested.select("profile_id", "user_name", "chunk", "n_matched", "match.*")


COMMON = (
    "user_name", "email", "followers", "business_type", "company_name", "product",
    "profit_in_a_percent", "profit_in_b_percent",
)


@query
def common_profiles(spark, sf):
    return op.common_rows(v.profiles(spark, sf), v.partnerships(spark, sf)).select(*COMMON)


@query
def exclusive_profiles(spark, sf):
    return op.exclusive_rows(v.profiles(spark, sf), v.partnerships(spark, sf)).select(
        "user_name", "email", "followers", "business_type"
    )


@query
def exclusive_sales(spark, sf):
    return op.exclusive_rows(v.partnerships(spark, sf), v.profiles(spark, sf))


@query
def overlap_split(spark, sf):
    parts = op.overlap_split(v.profiles(spark, sf), v.partnerships(spark, sf))
    marked = {kind: df.select(F.lit(kind).alias("kind"), "*") for kind, df in parts.items()}
    return sources.combined_view(marked, {})


@query
def join_inner(spark, sf):
    bp, sp = v.profiles(spark, sf), v.partnerships(spark, sf)
    return bp.join(sp, bp["user_name"] == sp["username"]).select(
        "user_name", "followers", "product", "profit_in_a_percent"
    )


@query
def entity_match(spark, sf):
    return op.entity_match(v.mediated_a(spark, sf), v.mediated_b(spark, sf))


@query
def entity_match_strict(spark, sf):
    return op.entity_match(v.mediated_a(spark, sf), v.mediated_b(spark, sf), op.Rule(STRICT))


def _described(spark, sf):
    """Both catalogs with longer names, so that strict pairs are few."""
    a = v.mediated_a(spark, sf).withColumn("name", F.concat_ws(" ", "name", "category"))
    b = v.catalog_b(spark, sf).select(
        F.concat_ws(" ", "description", "category", F.lit("goods")).alias("name"), "discount_price"
    )
    return a, b


@query
def entity_match_pairs(spark, sf):
    pairs = op.entity_match_pairs(*_described(spark, sf), op.Rule(PAIRS))
    return pairs.withColumns(
        {c: F.round(c, 6) for c in ("name_similarity", "price_similarity", "score")}
    )


def _overlap_column(items, offers):
    columns = [c for c in items.columns if c not in ("_id", "nameitem")]
    return op.column_overlap(items, columns, offers, "business_category")


@query
def column_overlap(spark, sf):
    found = _overlap_column(combined_view(spark, sf), v.partnerships(spark, sf))
    return found.select("column", F.round("ratio", 6).alias("ratio"))


@query
def partner_products(spark, sf):
    # Both steps read what is written once.
    items = materialize(combined_view(spark, sf), "products")
    offers = materialize(v.partnerships(spark, sf), "partnerships")
    found = _overlap_column(items, offers).first()
    column = found["column"] if found else "nameitem"
    matched = op.partner_products(offers, items, column, written=True)
    # Without a column that speaks of categories nothing is a partner product.
    return matched if found else matched.limit(0)


B_COLUMNS = ("primary_key", *v.KEYED_B)


def _matches(spark, sf, keep, threshold):
    """Fields found in catalog A's documents against catalog B's columns; the
    first column of either side is its key and does not take part."""
    fields = sources.discover_fields(v.documents_a(spark, sf), "doc").where("ordinal > 0")
    return op.match_columns(spark, fields, B_COLUMNS[1:], threshold, keep)


@query
def schema_match_last(spark, sf):
    return _matches(spark, sf, "last", COLUMN_THRESHOLD).select(
        "column_a", "column_b", F.round("similarity", 6).alias("similarity")
    )


@query
def schema_match_best(spark, sf):
    return _matches(spark, sf, "best", BEST_THRESHOLD).select(
        "column_a", "column_b", F.round("similarity", 6).alias("similarity")
    )


@query
def mediated_mapping(spark, sf):
    matches = _matches(spark, sf, "last", COLUMN_THRESHOLD)
    return op.mediated_mapping(matches, ATTRIBUTES, OVERRIDES)


@query
def mediated_union(spark, sf):
    combined = combined_view(spark, sf)
    matches = op.match_columns(
        spark, combined.columns[1:], B_COLUMNS[1:], COLUMN_THRESHOLD, "last"
    )
    mapping = op.mediated_mapping(matches, ATTRIBUTES, OVERRIDES)
    return op.mediated_union(combined, v.catalog_b(spark, sf), mapping, "catalog_a", "catalog_b")


@query
def tfidf_rank(spark, sf):
    ranked = op.tfidf_rank(v.catalog_a(spark, sf), "nameitem", ITEM_QUERY)
    return ranked.select("name", *[F.round(c, 6).alias(c) for c in ranked.columns[1:]])


# --- aggregation -----------------------------------------------------------


@query
def agg_count(spark, sf):
    grouped = op.aggregate(v.profiles(spark, sf), ["business_type"], [("count", "*"), ("count", "email")])
    return grouped.withColumnRenamed("count_email", "n_emails")


@query
def agg_sum(spark, sf):
    return op.aggregate(v.table(spark, sf, "lineitem"), ["l_partkey"], [("sum", "l_quantity")])


@query
def agg_avg(spark, sf):
    grouped = op.aggregate(v.table(spark, sf, "lineitem"), ["l_suppkey"], [("avg", "l_quantity")])
    return grouped.withColumn("avg_l_quantity", F.round("avg_l_quantity", 10))


@query
def agg_min(spark, sf):
    return op.aggregate(v.table(spark, sf, "orders"), ["o_custkey"], [("min", "o_totalprice")])


@query
def agg_max(spark, sf):
    return op.aggregate(v.table(spark, sf, "orders"), ["o_custkey"], [("max", "o_totalprice")])


@query
def agg_global(spark, sf):
    return op.aggregate(
        v.table(spark, sf, "lineitem"),
        [],
        [("count", "*"), ("sum", "l_quantity"), ("min", "l_extendedprice"), ("max", "l_extendedprice")],
    )


@query
def agg_count_distinct(spark, sf):
    return (
        v.table(spark, sf, "lineitem")
        .groupBy("l_returnflag")
        .agg(F.countDistinct("l_partkey").alias("n_parts"))
    )


MEASURES = [
    ("count", "*"),
    ("sum", "l_quantity"),
    ("avg", "l_discount"),
    ("min", "l_extendedprice"),
    ("max", "l_extendedprice"),
]


@query
def group_single(spark, sf):
    grouped = op.aggregate(v.table(spark, sf, "lineitem"), ["l_returnflag"], MEASURES)
    return grouped.withColumn("avg_l_discount", F.round("avg_l_discount", 10))


@query
def group_multi(spark, sf):
    grouped = op.aggregate(
        v.table(spark, sf, "lineitem"), ["l_returnflag", "l_linestatus"], MEASURES
    )
    return grouped.withColumn("avg_l_discount", F.round("avg_l_discount", 10))


@query
def group_nested_key(spark, sf):
    keys = ["o_orderstatus", "o_orderpriority"]
    grouped = op.aggregate(v.table(spark, sf, "orders"), keys, [("count", "*")])
    return op.nest_key(grouped, keys).withColumn("_id", F.to_json("_id"))


@query
def distinct(spark, sf):
    return v.profiles(spark, sf).select("business_type").distinct()


@query
def dedup_rows(spark, sf):
    return v.table(spark, sf, "lineitem").select("l_partkey", "l_suppkey").dropDuplicates()


@query
def distinct_values(spark, sf):
    return v.partnerships(spark, sf).select("email").distinct()


@query
def top_rows_report(spark, sf):
    bp, sp = v.profiles(spark, sf), v.partnerships(spark, sf)
    report = op.top_rows_report(
        {
            "most_followed": (bp, "followers", "_id"),
            "top_a_profit": (sp, "profit_in_a_percent", "_id"),
            "top_b_profit": (sp, "profit_in_b_percent", "_id"),
        }
    )
    return report.select(
        "type",
        F.get_json_object("data", "$._id").alias("id"),
        F.get_json_object("data", "$.email").alias("email"),
    )


# --- order and limit -------------------------------------------------------


@query
def order_desc(spark, sf):
    return (
        v.table(spark, sf, "orders")
        .select("o_orderkey", "o_totalprice")
        .orderBy(F.desc("o_totalprice"), "o_orderkey")
    )


@query
def order_asc(spark, sf):
    return (
        v.catalog_b(spark, sf)
        .select("name", "actual_price", "image_links")
        .orderBy("actual_price", "image_links")
    )


@query
def order_multi(spark, sf):
    return (
        v.table(spark, sf, "orders")
        .select("o_orderpriority", "o_totalprice", "o_orderkey")
        .orderBy("o_orderpriority", F.desc("o_totalprice"), "o_orderkey")
    )


@query
def order_price_text(spark, sf):
    ordered = op.order_by_price_text(v.catalog_a(spark, sf), "reducedprice", False, "_id")
    return ordered.select("_id", "reducedprice", op.price_key("reducedprice").alias("price"))


@query
def limit(spark, sf):
    return v.table(spark, sf, "orders").select("o_orderkey", "o_custkey").orderBy("o_orderkey").limit(5)


@query
def topk(spark, sf):
    return (
        v.table(spark, sf, "lineitem")
        .select("l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice")
        .orderBy(F.desc("l_extendedprice"), "l_orderkey", "l_linenumber", "l_partkey")
        .limit(10)
    )


@query
def topk_filtered(spark, sf):
    return (
        v.partnerships(spark, sf)
        .where(F.col("profit_in_a_percent") > 0.15)
        .select("_id", "username", "company_name", "product", "profit_in_a_percent")
        .orderBy(F.desc("profit_in_a_percent"), "_id")
        .limit(5)
    )


@query
def topk_federated(spark, sf):
    branches = [
        v.catalog_b(spark, sf).select("name", "discount_price", "image_links"),
        v.catalog_a(spark, sf).select(
            F.col("nameitem").alias("name"),
            price_to_number("reducedprice").alias("discount_price"),
            F.col("image").alias("image_links"),
        ),
    ]
    order = [F.desc_nulls_last("discount_price"), F.asc("name"), F.asc("image_links")]
    return op.top_k_federated(branches, order, 20, 10)


# --- set operations --------------------------------------------------------


@query
def union_all(spark, sf):
    b = v.catalog_b(spark, sf).select("name", F.col("discount_price").alias("price"))
    a = v.catalog_a(spark, sf).select("nameitem", price_to_number("reducedprice"))
    return b.union(a)


@query
def union_by_name_complete(spark, sf):
    b = v.catalog_b(spark, sf).select("name", F.col("highlights").alias("price_text"))
    drifted = v.catalog_a(spark, sf).select(F.col("nameitem"), F.col("reducedprice").alias("price_text"))
    aligned = drifted.withColumnRenamed("nameitem", "name")
    return op.union_complete([b, drifted, aligned])


# --- pipelines, run end to end and read back from what they loaded ----------


@query
def pipeline_resolve_entities(spark, sf):
    path = new_path(spark, "resolved")
    pipelines.resolve_entities(v.raw_mediated_a(spark, sf), v.raw_mediated_b(spark, sf), path)
    return spark.read.parquet(path)


@query
def pipeline_load_mediated(spark, sf):
    path = new_path(spark, "loaded")
    name = path.rsplit("/", 1)[1].replace("-", "_")
    a, b = combined_view(spark, sf), global_view_keyed(spark, sf)
    for _ in range(2):  # the second load finds nothing new
        pipelines.load_mediated(
            a, b, path, ATTRIBUTES, OVERRIDES, ("catalog_a", "catalog_b"), COLUMN_THRESHOLD, LOADED, name
        )
    spark.sql(f"DROP TABLE {name}")  # of the catalog; the files stay
    return spark.read.parquet(path).drop(sinks.ROW)


@query
def pipeline_influencer_overlap(spark, sf):
    paths = pipelines.influencer_overlap(
        v.profiles(spark, sf), v.partnerships(spark, sf), new_path(spark, "influencers"), BEST_OF
    )
    loaded = {kind: spark.read.parquet(path) for kind, path in paths.items()}
    fields = {f.name: f.dataType for name in ("only_profiles", "only_sales") for f in loaded[name].schema}
    document = T.StructType([T.StructField(name, kind) for name, kind in fields.items()])
    best = loaded.pop("best_of").select("type", F.from_json("data", document).alias("row"))
    views = {kind: df.select(F.lit(kind).alias("output"), "*") for kind, df in loaded.items()}
    views["best_of"] = best.select(F.col("type").alias("output"), "row.*")
    return sources.combined_view(views, {})


@query
def pipeline_partner_products(spark, sf):
    path = new_path(spark, "partners")
    pipelines.load_partner_products(v.partnerships(spark, sf), combined_view(spark, sf), path)
    return spark.read.parquet(path)


@query
def pipeline_refresh_catalog(spark, sf):
    path = new_path(spark, "refreshed")
    tables = {t: f"SELECT * FROM parquet.`{sf}/{t}.parquet`" for t in DRIVER_TABLES}
    sources.register_source(spark, "refreshed", tables)
    pipelines.refresh_catalog(spark, ["refreshed"], path)
    return sources.read_catalog_snapshot(spark, path)


@query
def metadata_json_sink(spark, sf):
    path = new_path(spark, "metadata")
    for source, tables in v.sql_views(sf).items():
        sources.register_source(spark, f"described_{source}", tables)
    names = [f"described_{source}" for source in v.sql_views(sf)]
    sources.write_catalog_snapshot(sources.catalog_snapshot(spark, names), path)
    found = sources.read_catalog_snapshot(spark, path)
    return found.select("source", "table", "ordinal", "column", "type")


@query
def image_link_match(spark, sf):
    a = v.catalog_a(spark, sf).select(F.col("nameitem").alias("name"), F.col("image").alias("link"))
    b = v.catalog_b(spark, sf).select("name", F.col("image_links").alias("link"))
    return op.entity_match(a, b, IMAGE_RULE)


@query
def partner_products_regex(spark, sf):
    kind = F.col("business_category")
    offers = v.partnerships(spark, sf).withColumn(
        "business_category", F.when(kind == "", kind).otherwise(F.concat(F.lit("^"), kind, F.lit(r"\b")))
    )
    return op.partner_products(offers, combined_view(spark, sf), "sub_category", regex=True)


@query
def limit_bare(spark, sf):
    # which rows come is open, how many is not
    return v.table(spark, sf, "orders").limit(7).agg(F.count("o_orderkey").alias("n_rows"))


# --- scalar functions ------------------------------------------------------


@query
def price_to_number_query(spark, sf):
    return v.catalog_a(spark, sf).select(
        "_id",
        price_to_number("reducedprice").alias("reduced"),
        price_to_number("actualprice").alias("actual"),
    )


@query
def price_similarity_query(spark, sf):
    return v.table(spark, sf, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        F.round(price_similarity("l_extendedprice", F.col("l_quantity") * 1000), 10).alias("similarity"),
    )


def _name_pairs(spark, sf):
    part = v.table(spark, sf, "part")
    return part.selectExpr(
        "p_partkey", f"{v.CATALOG_A['nameitem']} AS a", f"lower({v.CATALOG_B['name']}) AS b"
    )


@query
def jaro_winkler_query(spark, sf):
    return _name_pairs(spark, sf).select(
        "p_partkey", F.round(jaro_winkler("a", "b"), 6).alias("similarity")
    )


@query
def indel_ratio_query(spark, sf):
    return _name_pairs(spark, sf).select(
        "p_partkey", F.round(indel_ratio("a", "b"), 6).alias("similarity")
    )


# --- SQL surface -----------------------------------------------------------


@query
def sql_over_views(spark, sf):
    for source, tables in v.sql_views(sf).items():
        sources.register_source(spark, source, tables)
    return spark.sql(
        """
        SELECT name, discount_price FROM shop_b.products WHERE ratings > 4.5
        UNION ALL
        SELECT nameitem, try_cast(regexp_replace(reducedprice, '[₹,]', '') AS DOUBLE)
        FROM shop_a.items WHERE lower(nameitem) LIKE '%ring%'
        UNION ALL
        SELECT business_type, avg(followers) FROM social.profiles
        GROUP BY business_type HAVING count(*) > 10
        """
    ).select("name", F.round("discount_price", 9).alias("discount_price"))


@query
def sql_over_mediated(spark, sf):
    entity_match(spark, sf).createOrReplaceTempView("mediated")
    return spark.sql(
        """
        SELECT source, category, count(*) AS count,
               min(discount_price) AS min_price, max(actual_price) AS max_price
        FROM mediated WHERE ratings > 2 GROUP BY source, category
        """
    )


@query
def category_compare(spark, sf):
    matched = entity_match(spark, sf).withColumn("kind", F.upper(F.split("category", " ")[0]))
    compared = (
        matched.groupBy("kind")
        .pivot("source", ["catalog_a", "catalog_b"])
        .agg(
            F.count(F.lit(1)).alias("products"),
            F.sum("discount_price").cast("double").alias("total_price"),
            F.avg("ratings").alias("rating"),
        )
    )
    return compared.withColumns(
        {c: F.round(c, 10) for c in compared.columns if c.endswith("rating")}
    )

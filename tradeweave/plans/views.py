"""The domain views over the driver tables, and the same views as SQL text.

Each view covers its whole table.  The columns are given as Spark SQL
expressions so that one definition serves the DataFrames and the SQL views.

``catalog_a``     product documents: text prices (some missing or unreadable),
                  own field names, one drifted collection
``catalog_b``     relational products: numeric prices
``profiles``      influencers; those of one market segment have no email
``partnerships``  sales partnerships of influencers with product companies
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tradeweave.operators import select_mapped
from tradeweave.sinks import quarantine
from tradeweave.sources import Branch

# part.p_type values with a product table of their own; the rest, null included, shares one.
CATEGORIES = ("ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD")
DRIFTED = "PROMO"

_LIST_CENTS = "(CAST(round(p_retailprice * 100) AS BIGINT) * (p_size + 10) div 10)"


def _price_text(cents: str) -> str:
    return f"concat('₹', format_number(CAST({cents} AS DOUBLE) / 100, 2))"


CATALOG_A = {
    "_id": "p_partkey",
    "nameitem": "concat(p_name, ' ', p_brand)",
    "main_category": "p_type",
    "sub_category": "concat(substr(p_type, 1, 1), lower(substr(p_type, 2)), ' goods')",
    "image": "concat('img/', p_partkey, '.jpg')",
    "link": "concat('shop.example/', p_partkey)",
    "user_ratings": "CAST(p_size / 10D AS STRING)",
    "reducedprice": (
        "CASE p_size WHEN 13 THEN 'n/a' WHEN 17 THEN NULL WHEN 19 THEN 'NULL'"
        f" ELSE {_price_text(_LIST_CENTS)} END"
    ),
    "actualprice": _price_text(f"({_LIST_CENTS} * 6 div 5)"),
}

CATALOG_B = {
    "category": "p_type",
    "name": "concat(upper(p_name), ' ', p_type)",
    "ratings": "p_size / 10D",
    "discount_price": f"CAST({_LIST_CENTS} * 9 div 10 AS DOUBLE) / 100",
    "actual_price": f"CAST({_LIST_CENTS} AS DOUBLE) / 100",
    "seller_name": "p_brand",
    "seller_rating": "p_size / 20D",
    "description": "concat(p_name, ' by ', p_brand)",
    "highlights": "concat(p_type, ', size ', p_size)",
    "image_links": "concat('img/', p_partkey, '.jpg')",
}

KEYED_B = (
    "category", "name", "ratings", "discount_price", "actual_price",
    "description", "highlights", "image_links",
)

PROFILES = {
    "_id": "c_custkey",
    "user_name": "c_name",
    "email": (
        "CASE WHEN c_mktsegment <> 'BUILDING' THEN concat('u', c_custkey, '@mail.example') END"
    ),
    "followers": "CAST(floor(c_acctbal) AS BIGINT)",
    "posts": "c_nationkey",
    "business_type": "c_mktsegment",
}

PARTNERSHIPS = {
    "_id": "event_id",
    "username": "concat('Customer#', lpad(user_id, 9, '0'))",
    "email": "concat('u', user_id, '@mail.example')",
    "business_category": (
        "CASE event_type WHEN 'click' THEN 'Economy' WHEN 'view' THEN 'small'"
        " WHEN 'purchase' THEN 'Standard' WHEN 'signup' THEN 'LARGE' ELSE '' END"
    ),
    "company_name": "concat(split(p_name, ' ')[1], ' ', p_brand)",
    "product": "p_name",
    "profit_in_a_percent": "k / 100D",
    "profit_in_b_percent": "value",
}

# Source column -> mediated column.
A_TO_MEDIATED = {
    "nameitem": "name",
    "sub_category": "category",
    "user_ratings": "ratings",
    "reducedprice": "discount_price",
    "actualprice": "actual_price",
}
B_TO_MEDIATED = {
    "name": "name",
    "category": "category",
    "ratings": "ratings",
    "discount_price": "discount_price",
    "actual_price": "actual_price",
}


def _columns(view: dict[str, str]) -> list[str]:
    return [f"{expr} AS `{name}`" for name, expr in view.items()]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def catalog_a(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").selectExpr(*_columns(CATALOG_A))


def catalog_b(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").selectExpr(*_columns(CATALOG_B))


def _unlisted(column: str):
    return F.col(column).isNull() | ~F.col(column).isin(*CATEGORIES)


def collections_a(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """Catalog A as one collection per category; one calls its name field differently."""
    items = catalog_a(spark, sf_dir)
    parts = {c.lower(): items.where(F.col("main_category") == c) for c in CATEGORIES}
    parts["other"] = items.where(_unlisted("main_category"))
    drifted = DRIFTED.lower()
    parts[drifted] = parts[drifted].withColumnRenamed("nameitem", "nameitems")
    return parts


def tables_b(spark: SparkSession, sf_dir: str) -> list[DataFrame]:
    """Catalog B as one table per category."""
    products = catalog_b(spark, sf_dir)
    listed = [products.where(F.col("category") == c) for c in CATEGORIES]
    return [*listed, products.where(_unlisted("category"))]


def branches_a() -> dict[str, Branch]:
    """The collections of catalog A as branches of the whole catalog."""
    names = {c: F.col("main_category") == c for c in CATEGORIES}
    branches = {c.lower(): Branch(where) for c, where in names.items()}
    branches["other"] = Branch(_unlisted("main_category"))
    branches[DRIFTED.lower()] = Branch(names[DRIFTED], {"nameitem": "nameitems"})
    return branches


def branches_b() -> dict[str, Branch]:
    """The tables of catalog B as branches of the whole catalog."""
    listed = {c.lower(): Branch(F.col("category") == c) for c in CATEGORIES}
    return {**listed, "other": Branch(_unlisted("category"))}


def documents_a(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Catalog A as JSON documents in column ``doc``; a null field is absent."""
    items = catalog_a(spark, sf_dir)
    drifted = F.col("main_category") == DRIFTED
    fields = [
        F.when(~drifted, F.col("nameitem")).alias("nameitem"),
        F.when(drifted, F.col("nameitem")).alias("nameitems"),
    ]
    rest = [c for c in items.columns if c not in ("_id", "nameitem")]
    return items.select(F.to_json(F.struct("_id", *fields, *rest)).alias("doc"))


def profiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").selectExpr(*_columns(PROFILES))


def partnerships(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").withColumn(
        "k", F.get_json_object("props", "$.k").cast("bigint")
    )
    part = table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_brand")
    return events.join(part, F.col("k") == F.col("p_partkey")).selectExpr(*_columns(PARTNERSHIPS))


def raw_mediated_a(spark: SparkSession, sf_dir: str) -> DataFrame:
    return select_mapped(catalog_a(spark, sf_dir), A_TO_MEDIATED, "catalog_a")


def raw_mediated_b(spark: SparkSession, sf_dir: str) -> DataFrame:
    return select_mapped(catalog_b(spark, sf_dir), B_TO_MEDIATED, "catalog_b")


def mediated_a(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Catalog A under the mediated contract, castable rows only."""
    return quarantine(raw_mediated_a(spark, sf_dir))[0]


def mediated_b(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quarantine(raw_mediated_b(spark, sf_dir))[0]


def sql_views(sf_dir: str) -> dict[str, dict[str, str]]:
    """The sources as SELECT texts, for SQL over ``source.table``."""
    part = f"FROM parquet.`{sf_dir}/part.parquet`"
    return {
        "shop_a": {"items": f"SELECT {', '.join(_columns(CATALOG_A))} {part}"},
        "shop_b": {"products": f"SELECT {', '.join(_columns(CATALOG_B))} {part}"},
        "social": {
            "profiles": f"SELECT {', '.join(_columns(PROFILES))}"
            f" FROM parquet.`{sf_dir}/customer.parquet`"
        },
    }

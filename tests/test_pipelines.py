from conftest import rows

from tradeweave.plans import pipelines, queries
from tradeweave.sources import register_source
from tradeweave.workspace import new_path

RAW = "name string, category string, ratings string, discount_price string, actual_price string, source string"


def test_resolve_entities(spark):
    a = spark.createDataFrame(
        [("Boat Rockerz 255", "audio", "4.1", "₹1,299", "₹2,990", "a"),
         ("boat rockerz 255", "audio", "4.1", "n/a", "₹2,990", "a"),
         ("Qqqq", "x", None, "₹9", "₹9", "a")], RAW,
    )
    b = spark.createDataFrame(
        [("boAt Rockerz 255 Pro", None, "4.0", "1350", "2990", "b"), ("zzzz", "y", "1", "70000", "1", "b")], RAW
    )
    path = new_path(spark, "mediated")
    for _ in range(2):  # a repeated run replaces the table
        rejected = pipelines.resolve_entities(a, b, path)
    loaded = spark.read.parquet(path)
    assert rows(loaded.select("id", "name", "source")) == [
        (1, "Boat Rockerz 255", "a"), (2, "boAt Rockerz 255 Pro", "b")
    ]
    assert [r["discount_price"] for r in rejected.collect()] == ["n/a"]
    # Names that differ beyond the table's limit are compared whole, and not loaded.
    long = [(stem + tail, "c", "1", "5", "5", s) for stem, tail, s in (("k" * 500, "abcdef", "a"), ("k" * 500, "abcdef", "b"))]
    rejected = pipelines.resolve_entities(spark.createDataFrame(long[:1], RAW), spark.createDataFrame(long[1:], RAW), path)
    assert spark.read.parquet(path).count() == 0
    assert [[tuple(p) for p in r["problems"]] for r in rejected.collect()] == [[("name", "longer than 500")]] * 2


def test_load_mediated(spark):
    a = spark.createDataFrame([(1, "n", "₹5")], "_id int, nameitem string, reducedprice string")
    b = spark.createDataFrame([(1, "m", 7.5)], "primary_key int, name string, discount_price double")
    path = new_path(spark, "older")
    fixed = {"discountprice": ("reducedprice", "discount_price")}
    pipelines.load_mediated(a, b, path, ["name", "discountprice"], fixed, ("a", "b"))
    assert rows(spark.read.parquet(path)) == [("m", "7.5", "b"), ("n", "₹5", "a")]


def test_influencer_overlap(spark):
    profiles = spark.createDataFrame([(1, "e1", 5), (2, "e2", 9)], "_id int, email string, followers int")
    sales = spark.createDataFrame([(7, "e1", 0.5), (8, "e3", 0.1)], "_id int, email string, profit double")
    paths = pipelines.influencer_overlap(
        profiles, sales, new_path(spark, "overlap"),
        {"most_followed": ("profiles", "followers"), "top_profit": ("sales", "profit")},
    )
    loaded = {name: rows(spark.read.parquet(path)) for name, path in paths.items()}
    assert loaded["common"] == [(1, "e1", 5, 0.5)]
    assert loaded["only_profiles"] == [(2, "e2", 9)]
    assert loaded["only_sales"] == [(8, "e3", 0.1)]
    assert [r[0] for r in loaded["best_of"]] == ["most_followed", "top_profit"]


def test_partner_products(spark):
    deals = spark.createDataFrame(
        [(1, "audio", "boat"), (2, None, "x")], "_id int, business_category string, company_name string"
    )
    goods = spark.createDataFrame(
        [(5, "boAt Rockerz", "Audio gear", "i.jpg")], "_id int, nameitem string, kind string, image string"
    )
    path = new_path(spark, "partners")
    assert pipelines.load_partner_products(deals, goods, path) == "kind"
    assert rows(spark.read.parquet(path)) == [("audio", "boat", "boAt Rockerz", "Audio gear", "i.jpg", "kind")]


def test_partner_products_compute_each_input_once(spark):
    made = spark.sparkContext.accumulator(0)

    def counted(data, schema):
        return spark.createDataFrame(spark.sparkContext.parallelize(data, 2).map(lambda row: made.add(1) or row), schema)

    deals = counted([(1, "audio", "boat"), (2, None, "x"), (3, "audio", "boat")], "_id int, business_category string, company_name string")
    goods = counted([(5, "boAt Rockerz", "Audio gear"), (6, None, "toys")], "_id int, nameitem string, kind string")
    path = new_path(spark, "partners")
    assert pipelines.load_partner_products(deals, goods, path) == "kind"
    assert made.value == 5
    assert rows(spark.read.parquet(path)) == [("audio", "boat", "boAt Rockerz", "Audio gear", "kind")] * 2
    assert pipelines.load_partner_products(deals.limit(0), goods, new_path(spark, "none")) is None


def test_partner_query_computes_each_input_once(spark, monkeypatch):
    """The search for the column and the join read one copy of either input."""
    made = spark.sparkContext.accumulator(0)

    def counted(data, schema):
        return spark.createDataFrame(spark.sparkContext.parallelize(data, 2).map(lambda row: made.add(1) or row), schema)

    deals = counted([(1, "audio", "boat"), (2, None, "x"), (3, "audio", "boat")], "_id int, business_category string, company_name string")
    goods = counted([(5, "boAt Rockerz", "Audio gear"), (6, None, "toys")], "_id int, nameitem string, kind string")
    monkeypatch.setattr(queries.v, "partnerships", lambda spark, sf: deals)
    monkeypatch.setattr(queries, "combined_view", lambda spark, sf: goods)
    found = queries.partner_products(spark, "unused")
    assert rows(found) == [("audio", "boat", "boAt Rockerz", "Audio gear", "kind")] * 2
    assert made.value == 5
    monkeypatch.setattr(queries.v, "partnerships", lambda spark, sf: deals.limit(0))
    assert rows(queries.partner_products(spark, "unused")) == []


def test_refresh_catalog(spark):
    register_source(spark, "one_source", {"v": "SELECT 1 AS a, 'x' AS b"})
    path = new_path(spark, "catalog")
    pipelines.refresh_catalog(spark, ["one_source"], path)
    again = pipelines.refresh_catalog(spark, ["one_source"], path)
    assert rows(spark.read.json(path).select("column", "type")) == [("a", "int"), ("b", "string")]
    assert again.count() == 2

from conftest import plan_of, rows
from pyspark.sql import functions as F

from tradeweave.operators import (
    aggregate,
    drop_null_rows,
    nest_key,
    order_by_price_text,
    render_json,
    render_text,
    select_available,
    select_mapped,
    top_k_federated,
    union_complete,
)


def test_projections(spark):
    df = spark.createDataFrame([(1, "x", None)], "a int, b string, c double")
    assert select_available(df, ["b", "nope", "a"]).columns == ["b", "a"]
    assert select_mapped(df, {"b": "name"}, "left").collect() == [("x", "left")]
    assert render_text(df).collect() == [("1", "x", None)]
    assert render_json(df).first()[0] == '{"a":1,"b":"x"}'


def test_drop_null_rows(spark):
    df = spark.createDataFrame([("a", 1), ("NULL", 2), (None, 3), ("b", None)], "s string, n int")
    assert drop_null_rows(df).collect() == [("a", 1)]
    assert drop_null_rows(df, ["n"]).count() == 3


def test_price_text_order(spark):
    prices = ["₹1,299", "499", None, "n/a", "₹2,000.50", "-5"]
    df = spark.createDataFrame([(p, i) for i, p in enumerate(prices)], "p string, i int")
    ordered = [r["p"] for r in order_by_price_text(df, "p", False, "i").collect()]
    assert ordered == ["₹2,000.50", "₹1,299", "499", None, "n/a", "-5"]
    assert order_by_price_text(df, "p", True, "i").first()["p"] == "-5"


def test_union_complete_hides_gaps(spark):
    first = spark.createDataFrame([("a", "1"), ("b", None)], "name string, price string")
    renamed = spark.createDataFrame([("c", "2")], "names string, price string")
    more = spark.createDataFrame([("3", "d"), ("NULL", "e")], "price string, name string")
    assert rows(union_complete([first, renamed, more])) == [("a", "1"), ("d", "3")]


def test_generated_names_and_nested_key(spark):
    df = spark.createDataFrame([("a", 1), ("a", 3), ("b", 5)], "k string, x int")
    grouped = aggregate(df, ["k"], [("count", "*"), ("avg", "x"), ("sum", "x"), ("min", "x"), ("max", "x")])
    assert grouped.columns == ["k", "count", "avg_x", "sum_x", "min_x", "max_x"]
    assert rows(grouped) == [("a", 2, 2.0, 4, 1, 3), ("b", 1, 5.0, 5, 5, 5)]
    assert nest_key(grouped, ["k"]).columns[0] == "_id"
    assert aggregate(df, [], [("max", "x")]).collect() == [(5,)]


def test_two_level_top_k(spark):
    a, b = spark.range(100), spark.range(50, 200)
    top = top_k_federated([a, b], [F.desc("id")], 3, 4)
    assert [r["id"] for r in top.collect()] == [199, 198, 197, 99]
    assert plan_of(top).count("TakeOrderedAndProject") == 3


def test_count_of_a_column_skips_nulls(spark):
    df = spark.createDataFrame([("k", None), ("k", "x")], "k string, e string")
    grouped = aggregate(df, ["k"], [("count", "*"), ("count", "e")])
    assert grouped.columns == ["k", "count", "count_e"] and grouped.collect() == [("k", 2, 1)]

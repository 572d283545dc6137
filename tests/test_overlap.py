from conftest import plan_of, rows
from pyspark.sql import functions as F

from tradeweave.operators import (
    common_rows,
    exclusive_rows,
    lookup_nested,
    overlap_split,
    top_rows_report,
)


def profiles(spark):
    return spark.createDataFrame(
        [(1, "ann", "a@x", 10), (2, "bob", None, 30), (3, "cy", "c@x", 30), (4, "dee", "d@x", None)],
        "_id int, user_name string, email string, followers int",
    )


def sales(spark):
    return spark.createDataFrame(
        [(7, "a@x", "p"), (8, "a@x", "q"), (9, None, "r"), (10, "z@x", "s")],
        "_id int, email string, product string",
    )


def test_null_keys_match_null_keys_on_request(spark):
    common = common_rows(profiles(spark), sales(spark), null_safe=True).select("user_name", "email", "product")
    assert rows(common) == [("ann", "a@x", "p"), ("ann", "a@x", "q"), ("bob", None, "r")]
    parts = overlap_split(profiles(spark), sales(spark), null_safe=True)
    assert [r["user_name"] for r in parts["only_profiles"].orderBy("_id").collect()] == ["cy", "dee"]
    assert [r["_id"] for r in parts["only_sales"].collect()] == [10]


def test_null_keys_match_nothing(spark):
    assert common_rows(profiles(spark), sales(spark)).count() == 2
    alone = exclusive_rows(profiles(spark), sales(spark))
    assert [r["user_name"] for r in alone.orderBy("_id").collect()] == ["bob", "cy", "dee"]


def test_lookup_nests_matches(spark):
    nested = lookup_nested(profiles(spark), sales(spark), null_safe=True, chunks=1).orderBy("_id").collect()
    assert [len(r["matched"]) for r in nested] == [2, 1, 0, 0]
    assert {m["product"] for m in nested[0]["matched"]} == {"p", "q"}
    assert lookup_nested(profiles(spark), sales(spark), chunks=1).where("size(matched) > 0").count() == 1


def test_lookup_splits_a_frequent_key(spark):
    # A third of all rows share one key, half of those are copies of one row.
    left = spark.createDataFrame([("hot",), ("cold",), ("none",)], "email string")
    data = [("hot", 1)] * 300 + [("hot", i) for i in range(300)] + [(f"k{i}", i) for i in range(1200)]
    right = spark.createDataFrame(data + [("cold", 5)], "email string, v int").repartition(4)
    nested = lookup_nested(left, right, chunks=12).collect()
    hot = [r for r in nested if r["email"] == "hot"]
    assert len(hot) > 4
    assert sorted(m["v"] for r in hot for m in r["matched"]) == sorted(v for k, v in data if k == "hot")
    assert max(len(r["matched"]) for r in hot) < 300
    assert [(r["chunk"], len(r["matched"])) for r in nested if r["email"] == "none"] == [(0, 0)]


def test_top_rows_break_ties_by_id(spark):
    report = top_rows_report(
        {"most_followed": (profiles(spark), "followers", "_id"), "top": (sales(spark), "_id", "_id")}
    )
    assert rows(report) == [
        ("most_followed", '{"_id":2,"user_name":"bob","followers":30}'),
        ("top", '{"_id":10,"email":"z@x","product":"s"}'),
    ]
    assert "rangepartitioning" not in plan_of(report)
    none = top_rows_report({"top": (sales(spark).limit(0), "_id", "_id")})
    assert none.collect() == [("top", None)]


def test_lookup_does_not_depend_on_match_counts(spark):
    left = spark.createDataFrame([(1, "a"), (2, None), (3, "b")], "_id int, email string")
    right = spark.createDataFrame([("a", i) for i in range(50)] + [(None, 7)] * 3, "email string, v int")
    once = lookup_nested(left, right, chunks=1).orderBy("_id").collect()
    assert [(r["_id"], r["chunk"], len(r["matched"])) for r in once] == [(1, 0, 50), (2, 0, 0), (3, 0, 0)]
    spread = lookup_nested(left, right, chunks=5).where("_id = 1").collect()
    assert sorted(m["v"] for r in spread for m in r["matched"]) == list(range(50)) and len(spread) == 5


def test_null_keys_on_both_sides_are_not_paired(spark):
    left = spark.createDataFrame([(None, i) for i in range(200)], "email string, v int")
    right = spark.createDataFrame([(None, i) for i in range(200)], "email string, w int")
    assert common_rows(left, right).count() == 0


def test_a_hot_key_is_nested_in_bounded_arrays(spark):
    # one e-mail holds a third of all rows and is dealt evenly by the row's number
    left = spark.createDataFrame([("hot",), ("k1",)], "email string")
    right = spark.range(6400).selectExpr("CASE WHEN id % 3 = 0 THEN 'hot' ELSE concat('k', id) END AS email", "id AS v")
    nested = lookup_nested(left, right, deal=F.col("v")).where("email = 'hot'").collect()
    assert len(nested) == 64 and max(len(r["matched"]) for r in nested) <= 35
    assert sorted(m["v"] for r in nested for m in r["matched"]) == list(range(0, 6400, 3))
    hashed = lookup_nested(left, right).where("email = 'hot'").collect()
    assert max(len(r["matched"]) for r in hashed) < 80
    assert sorted(m["v"] for r in hashed for m in r["matched"]) == list(range(0, 6400, 3))

import os

import pytest
from conftest import plan_of, rows
from pyspark.sql import functions as F

from tradeweave import sinks, sources, workspace
from tradeweave.plans.queries import QUERIES
from tradeweave.workspace import new_path

RAW = "name string, category string, ratings string, discount_price string, actual_price string, source string"
GOOD = ("Ring", None, None, "₹1,299.456", "1,500", "s")


def raw(spark, *data):
    return spark.createDataFrame(list(data), RAW)


def test_quarantine_and_defaults(spark):
    bad_price, no_price = ("x", "c", "1", "n/a", "2", "s"), ("y", "c", "1", None, "2", "s")
    bad_rating, too_big = ("z", "c", "abc", "1", "2", "s"), ("w", "c", "1", "1", "123456789.0", "s")
    kept, rejected = sinks.quarantine(raw(spark, GOOD, bad_price, no_price, bad_rating, too_big))
    assert [str(v) for v in kept.first()] == ["Ring", "", "0.0", "1299.46", "1500.00", "s"]
    assert kept.count() == 1
    assert rows(rejected.select("name")) == [("w",), ("x",), ("y",), ("z",)]


def test_long_texts_stay_whole_and_are_not_written(spark):
    long = ("n" * 600, "c" * 200, "1", "1", "1", "s" * 60)
    row = sinks.coerce_to_contract(raw(spark, long)).first()
    assert [len(row[c]) for c in ("name", "category", "source")] == [600, 200, 60]
    assert sinks.quarantine(raw(spark, long))[0].count() == 1
    path = new_path(spark, "long")
    left_out = sinks.append_validated(raw(spark, GOOD, long), path)
    assert [r["name"] for r in spark.read.parquet(path).collect()] == ["Ring"]
    assert [r["name"] for r in left_out.collect()] == ["n" * 600]


def test_rejects_name_column_and_reason(spark):
    rows_in = [GOOD, ("x", "c", "abc", "n/a", None, "s"), ("n" * 501, "c", "1", "1", "1", "s"), (None, None, None, "1", "1", None)]
    report = sinks.rejects_report(raw(spark, *rows_in))
    found = {r["name"]: [tuple(p) for p in r["problems"]] for r in report.collect()}
    assert found == {
        "x": [("ratings", "not a double"), ("discount_price", "not a decimal(10,2)"), ("actual_price", "missing")],
        "n" * 501: [("name", "longer than 500")],
    }


def test_every_pair_of_types(spark):
    kinds = {"d": "date", "t": "timestamp", "f": "boolean", "p": "decimal(20,2)", "i": "bigint", "x": "double", "s": "string"}
    contract = sinks.Contract(kinds)
    text = spark.createDataFrame(
        [(" 2024-02-29 ", "2024-02-29 01:02:03", "true", "₹12,345,678,901,234,567.89", "9,007,199,254,740,993", "1e3", "é"),
         ("2023-02-29", "soon", "maybe", "1.2.3", "12.7", "NaN", "")],
        ", ".join(f"{c} string" for c in kinds),
    )
    good, bad = [tuple(r) for r in sinks.coerce_to_contract(text, contract).collect()]
    assert [str(v) for v in good] == [
        "2024-02-29", "2024-02-29 01:02:03", "True", "12345678901234567.89", "9007199254740993", "1000.0", "é"
    ]
    assert bad == (None, None, None, None, 12, None, "")
    typed = sinks.coerce_to_contract(text.limit(1), contract)
    assert rows(sinks.coerce_to_contract(typed, contract)) == rows(typed)
    odd = text.limit(1).select(
        F.lit(True).alias("d"), F.lit(1).alias("t"), F.lit(1.5).alias("f"), F.lit(True).alias("p"),
        F.current_date().alias("i"), F.lit(float("inf")).alias("x"), F.lit(7).alias("s"),
    )
    assert rows(sinks.coerce_to_contract(odd, contract)) == [(None, None, None, None, None, None, "7")]
    report = sinks.rejects_report(odd, contract).first()["problems"]
    assert [p["column"] for p in report] == ["d", "t", "f", "p", "i", "x"]


def test_contract_rejects_missing_and_unknown_columns(spark):
    path = new_path(spark, "contract")
    with pytest.raises(sinks.ContractError, match="missing required columns: source"):
        sinks.append_validated(raw(spark, GOOD).drop("source"), path)
    with pytest.raises(sinks.ContractError, match="unknown columns: extra"):
        sinks.append_validated(raw(spark, GOOD).withColumn("extra", F.lit(1)), path)
    sinks.append_validated(raw(spark, GOOD), path)
    sinks.append_validated(raw(spark, GOOD), path)
    assert spark.read.parquet(path).count() == 2


def test_append_new_only_is_idempotent(spark):
    path = new_path(spark, "new-only")
    first = spark.createDataFrame([("a", 1), (None, 2)], "k string, v int")
    sinks.overwrite(first, path)
    more = spark.createDataFrame([("a", 9), (None, 9), ("b", 3), ("b", 3)], "k string, v int")
    sinks.append_new_only(more, path, ["k"])
    sinks.append_new_only(more, path, ["k"])
    assert rows(spark.read.parquet(path)) == [("a", 1), ("b", 3), (None, 2)]


def test_overwrite_many_clears_empty_outputs(spark):
    folder = new_path(spark, "many")
    sinks.overwrite_many({"x": spark.range(3), "y": spark.range(2)}, folder)
    paths = sinks.overwrite_many({"x": spark.range(1), "y": spark.range(0)}, folder)
    assert [spark.read.parquet(paths[n]).count() for n in ("x", "y")] == [1, 0]


def test_write_with_count(spark):
    path = new_path(spark, "count")
    assert sinks.write_with_count(spark.range(7), path) == 7
    assert spark.read.parquet(path).count() == 7


def test_surrogate_key_is_dense_under_skew(spark):
    df = spark.range(3000).select(F.when(F.col("id") < 1000, 5).otherwise(F.col("id")).alias("p"), "id")
    keyed = sinks.with_surrogate_key(df, ["p", "id"], "k").collect()
    assert [r["k"] for r in sorted(keyed, key=lambda r: (r["p"], r["id"]))] == list(range(1, 3001))
    assert sinks.with_surrogate_key(df.limit(0), ["p", "id"]).count() == 0


def test_insert_values(spark):
    path = new_path(spark, "insert")
    df = spark.createDataFrame([("a", 1)], "k string, v int")
    sinks.overwrite(df, path)
    sources.register_source(spark, "test_loads", {"t": path})
    sinks.insert_values(spark.table("test_loads.t"), "test_loads.t", [("b", 2)])
    assert rows(sources.read_relational(spark, "test_loads.t")) == [("a", 1), ("b", 2)]
    found = sources.catalog_snapshot(spark, ["test_loads"])
    assert rows(found) == [("test_loads", "t", 1, "k", "string"), ("test_loads", "t", 2, "v", "int")]
    out = new_path(spark, "snapshot")
    sources.write_catalog_snapshot(found, out)
    assert spark.read.json(out).count() == 2


def test_drifted_collections_line_up(spark):
    a = spark.createDataFrame([(1, "x", "m")], "_id int, nameitem string, main_category string")
    b = spark.createDataFrame([(2, "y", 5)], "_id int, nameitems string, extra int")
    view = sources.combined_view({"a": a, "b": b}, {"b": {"nameitems": "nameitem"}}, ["main_category"])
    assert rows(view) == [(1, "x", None), (2, "y", 5)]


def test_csv_keeps_broken_lines_apart(spark):
    path = new_path(spark, "csv")
    spark.createDataFrame(
        [("name,price",), ('"  ring, ""big"" ","₹1,000"',), (",n/a",), ("a,1,2,3,4",)], "l string"
    ).coalesce(1).write.text(path)
    from pyspark.sql.types import StringType, StructType

    schema = StructType().add("name", StringType()).add("price", StringType()).add("_corrupt_record", StringType())
    found = sources.ingest_csv(spark, path, schema, ["name"], ["price"])
    assert rows(found.select("name", "price")) == [("a", 1.0), ('ring, "big"', 1000.0), (None, None)]
    broken = found.where("_corrupt_record IS NOT NULL").select("name", "_corrupt_record")
    assert ("a", "a,1,2,3,4") in rows(broken)


def test_field_profile_sees_rare_fields(spark):
    docs = spark.createDataFrame(
        [('{"_id":1,"a":2}',), ('{"_id":2,"b":null,"a":1}',), ("not json",), (None,)], "doc string"
    )
    assert rows(sources.field_profile(docs, "doc")) == [
        ("_id", 0, 2, 0.5), ("a", 2, 2, 0.5), ("b", 1, 1, 0.25)
    ]
    found = sources.discover_fields(docs, "doc").orderBy("ordinal", "field")
    assert [r["field"] for r in found.collect()] == ["_id", "b", "a"]


def test_ids(spark):
    df = spark.createDataFrame([(1, "x")], "_id int, n string")
    assert sources.drop_id(df).columns == ["n"]
    assert sources.id_as_string(df).collect() == [("1", "x")]


def test_keyed_view(spark):
    parts = [spark.createDataFrame([(c, i) for i in range(3)], "c string, i int") for c in "ba"]
    keyed = sources.global_view_keyed(parts, ["i"], ["c", "i"])
    assert sorted(tuple(r) for r in keyed.collect()) == [(k, (k - 1) % 3) for k in range(1, 7)]


def test_append_new_keyed(spark):
    path = new_path(spark, "keyed")
    first = spark.createDataFrame([("b", None), ("a", 1), ("a", 1)], "name string, n int")
    sinks.append_new_keyed(first, path)
    sinks.append_new_keyed(first.union(spark.createDataFrame([(None, 2)], first.schema)), path)
    sinks.append_new_keyed(first.limit(0), path)
    assert rows(spark.read.parquet(path)) == [(1, "a", 1), (2, "b", None), (3, None, 2)]


def test_surrogate_key_moves_no_row_again(spark):
    keyed = sinks.with_surrogate_key(spark.range(1000).selectExpr("id * 7 % 1000 AS v"), ["v"])
    assert [r["id"] for r in keyed.orderBy("v").collect()] == list(range(1, 1001))
    plan = plan_of(keyed)
    assert "SortMergeJoin" not in plan and "BroadcastHashJoin" in plan


def test_bucketed_load_adds_new_rows_only(spark):
    path = new_path(spark, "bucketed")
    first = spark.createDataFrame([("b", None), ("a", 1), ("a", 1)], "name string, n int")
    sinks.append_new_bucketed(first, "bucketed_load", path, buckets=4)
    spark.sql("DROP TABLE bucketed_load")  # an external table is taken up again from its files
    more = first.union(spark.createDataFrame([(None, 2), (None, 2)], first.schema))
    sinks.append_new_bucketed(more, "bucketed_load", path, buckets=4)
    sinks.append_new_bucketed(more.limit(0), "bucketed_load", path, buckets=4)
    assert rows(spark.table("bucketed_load").drop(sinks.ROW)) == [(1, "a", 1), (2, "b", None), (3, None, 2)]
    with pytest.raises(ValueError):
        sinks.append_new_bucketed(first.withColumnRenamed("n", sinks.ROW), "bucketed_load", path)
    spark.sql("DROP TABLE bucketed_load")


def test_bucketed_load_does_not_shuffle_what_is_stored(spark):
    path = new_path(spark, "unmoved")
    df = spark.range(500).selectExpr("concat('n', id) AS name", "id % 7 AS n")
    sinks.append_new_bucketed(df, "unmoved_load", path, buckets=8)
    found = sinks.rows_not_in(df.union(spark.createDataFrame([("new", 1)], "name string, n long")), spark.table("unmoved_load"))
    assert found.collect() == [("new", 1)]
    plan = found._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    known = plan[plan.index("LeftAnti"):]
    lines = known.splitlines()
    scan = next(i for i, line in enumerate(lines) if "unmoved_load" in line)
    depth = lambda line: len(line) - len(line.lstrip(" :+-"))
    above, level = [], depth(lines[scan])
    for line in reversed(lines[:scan]):
        if depth(line) < level:
            above.append(line)
            level = depth(line)
    assert "Bucketed: true" in lines[scan] and not any("Exchange" in line or "Shuffle" in line for line in above)
    spark.sql("DROP TABLE unmoved_load")


def test_branches_equal_the_union_of_their_parts(spark):
    whole = spark.createDataFrame(
        [(1, "a", 5), (2, "b", 6), (3, None, 7), (4, "c", 8), (5, "ab", 9)], "id int, kind string, v int"
    )
    has = lambda x: F.col("kind").contains(x)
    branches = {"a": sources.Branch(has("a")), "b": sources.Branch(has("b"), {"v": "w"}), "b`s": sources.Branch(has("z"))}
    parts = {"a": whole.where(has("a")), "b": whole.where(has("b")).withColumnRenamed("v", "w"), "b`s": whole.where(has("z"))}
    for renames in ({}, {"b": {"w": "v"}}):
        view = sources.branch_view(whole, branches, renames, ["kind"])
        assert rows(view.drop("branch")) == rows(sources.combined_view(parts, renames, ["kind"]))
        assert rows(view.select("id", "branch")) == [(1, "a"), (2, "b"), (5, "a"), (5, "b")]
    assert sources.branch_view(whole.limit(0), branches).count() == 0


def test_a_scope_removes_what_was_written_inside(spark):
    kept = new_path(spark, "kept")
    with workspace.scope(spark):
        made = new_path(spark, "made")
        df = workspace.materialize(spark.range(5).toDF("x"), "scoped")
        with workspace.scope(spark):
            inner = new_path(spark, "inner")
            df.write.parquet(inner)
        assert not os.path.exists(inner)
        df.write.parquet(kept)
        scoped = df.inputFiles()[0].removeprefix("file://")
        assert os.path.exists(scoped)
    assert not os.path.exists(made) and not os.path.exists(scoped)
    assert spark.read.parquet(kept).count() == 5
    with pytest.raises(RuntimeError), workspace.scope(spark):
        spark.range(1).write.parquet(path := new_path(spark, "failed"))
        raise RuntimeError
    assert not os.path.exists(path)


def test_an_empty_or_absent_path_can_be_removed(spark):
    workspace.remove(spark, new_path(spark, "never-written"))


def test_views_scan_their_table_once(spark):
    for name in ("global_view", "combined_view"):
        plan = plan_of(QUERIES[name](spark, "/root/testdata/sf0.001"))
        assert plan.count("FileScan parquet") == 1 and "Union" not in plan, name

import random

from conftest import rows

from tradeweave.functions.similarity import indel_pairs
from tradeweave.operators import column_overlap, match_columns, mediated_mapping, mediated_union, schema_match
from tradeweave.plans.queries import ATTRIBUTES, OVERRIDES
from tradeweave.plans.views import CATALOG_A, KEYED_B

COLUMNS_A = [c for c in CATALOG_A if c not in ("_id", "main_category")]
COLUMNS_B = list(KEYED_B)


def test_last_and_best_match(spark):
    last = match_columns(spark, COLUMNS_A, COLUMNS_B, 0.7, "last")
    assert {r["column_a"]: r["column_b"] for r in last.collect()} == {
        "nameitem": "name", "sub_category": "category", "image": "image_links",
        "user_ratings": "ratings", "reducedprice": "discount_price", "actualprice": "actual_price",
    }
    best = match_columns(spark, COLUMNS_A, COLUMNS_B, 0.85)
    assert {r["column_a"]: round(r["similarity"], 3) for r in best.collect()} == {
        "nameitem": 0.9, "sub_category": 0.889, "image": 0.891, "actualprice": 0.983
    }


def test_first_column_wins_a_tie(spark):
    best = match_columns(spark, ["price"], ["PRICE", "price"], 0.85)
    assert best.first()["column_b"] == "PRICE"
    last = match_columns(spark, ["price"], ["price_x", "price_y"], 0.7, "last")
    assert last.first()["column_b"] == "price_y"


def test_mapping_and_union(spark):
    mapping = mediated_mapping(
        match_columns(spark, COLUMNS_A, COLUMNS_B, 0.7, "last"), ATTRIBUTES, OVERRIDES
    )
    pairs = {r["attribute"]: (r["column_a"], r["column_b"]) for r in mapping.collect()}
    assert pairs["discountprice"] == ("reducedprice", "discount_price")
    assert pairs["imagelinks"] == ("image", "image_links")
    a = spark.createDataFrame([tuple("abcdefg")] * 2, COLUMNS_A)
    b = spark.createDataFrame([tuple("hijklmno")] * 3, COLUMNS_B)
    union = mediated_union(a, b, mapping, "left", "right")
    assert union.columns == [*ATTRIBUTES, "source"]
    assert union.groupBy("source").count().orderBy("source").collect() == [("left", 2), ("right", 3)]


VALUES = [("Shoes & more", "img1", None), ("bags", "img2", ""), ("hats", "img3", "shoe")]


def overlap(spark, categories, columns=("kind", "image", "note")):
    df = spark.createDataFrame(VALUES, "kind string, image string, note string")
    wanted = spark.createDataFrame([(c,) for c in categories], "c string")
    return rows(column_overlap(df, columns, wanted, "c"))


def test_equal_value_settles_the_column(spark):
    assert overlap(spark, ["shoe", "zzz", None, ""]) == [("note", 1.0)]


def test_most_similar_value(spark):
    categories = ["Bagz", "img", "hat"]
    best = max(indel_pairs([c], [v])[0] for c in categories for row in VALUES for v in row if v)
    assert overlap(spark, categories) == [("kind", best)]


def test_first_column_wins_equal_ratios(spark):
    assert overlap(spark, ["img"], ("note", "image", "kind"))[0][0] == "image"
    assert overlap(spark, ["img2"], ("image", "kind"))[0][0] == "image"


def test_best_value_equals_brute_force(spark):
    rng = random.Random(12)
    for size in (1, 4, 9):
        table = [["".join(rng.choices("abcdé😀 ", k=rng.randint(0, size))) or None for _ in range(3)] for _ in range(30)]
        categories = ["".join(rng.choices("abcdxyz", k=rng.randint(1, size + 2))) + "!" for _ in range(8)]
        df = spark.createDataFrame(table, "p string, q string, r string")
        scored = [
            (indel_pairs([c], [v])[0], -at) for c in categories for row in table for at, v in enumerate(row) if v
        ]
        best, at = max(scored)
        wanted = spark.createDataFrame([(c,) for c in categories], "c string")
        assert rows(column_overlap(df, ["p", "q", "r"], wanted, "c")) == ([("pqr"[-at], best)] if best else [])


def test_few_categories_do_not_shuffle_the_values(spark, monkeypatch):
    """The values are scored where they are, in blocks of long and short texts."""
    rng = random.Random(3)
    table = [("".join(rng.choices("abcd é😀", k=rng.choice([0, 1, 7, 300]))) or None, f"img/{i}") for i in range(200)]
    categories = ["".join(rng.choices("abcdxyé", k=rng.choice([2, 5, 290]))) + "!" for _ in range(12)]
    scored = [(indel_pairs([c], [v])[0], -at) for c in categories for row in table for at, v in enumerate(row) if v]
    best, at = max(scored)
    df = spark.createDataFrame(table, "p string, q string")
    wanted = spark.createDataFrame([(c,) for c in categories], "c string")
    monkeypatch.setattr(schema_match, "MAP_CELLS", 1 << 10)
    monkeypatch.setattr(schema_match, "SCORED_PAIRS", 3)
    with monkeypatch.context() as few:
        few.setattr(schema_match, "overlap_pairs", None)
        assert rows(column_overlap(df, ["p", "q"], wanted, "c")) == [("pq"[-at], best)]
    monkeypatch.setattr(schema_match, "HELD_CHARS", 0)
    assert rows(column_overlap(df, ["p", "q"], wanted, "c")) == [("pq"[-at], best)]


def test_nothing_in_common(spark):
    assert overlap(spark, ["Q"]) == []


def test_two_attributes_on_one_column_and_none(spark):
    a = spark.createDataFrame([("x", 1)], "p string, q int")
    b = spark.createDataFrame([("y", 2)], "r string, s int")
    mapping = spark.createDataFrame(
        [("name", "p", "r"), ("title", "p", "s"), ("other", None, "r")], "attribute string, column_a string, column_b string"
    )
    union = mediated_union(a, b, mapping, "A", "B")
    assert sorted(map(tuple, union.collect()), key=repr) == [("x", "x", None, "A"), ("y", "2", "y", "B")]


def test_overrides_apply_where_nothing_matched(spark):
    none = spark.createDataFrame([], "ordinal int, column_a string, column_b string, similarity double")
    mapping = mediated_mapping(none, ["name", "price"], {"price": ("p", "q")})
    assert sorted(map(tuple, mapping.collect())) == [("name", None, None), ("price", "p", "q")]

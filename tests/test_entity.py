import random
from decimal import Decimal

import pytest
from conftest import plan_of, rows
from pyspark.sql import functions as F
from test_functions import reference_jaro_winkler

from tradeweave.operators import Rule, entity, entity_match, entity_match_pairs, similarity_join

SCHEMA = (
    "name string, category string, ratings double, discount_price decimal(10,2),"
    " actual_price decimal(10,2), source string"
)


def score(name_a, price_a, name_b, price_b):
    top = max(price_a, price_b)
    close = 1 - abs(price_a - price_b) / top if top > 0 else 1.0
    return 0.7 * reference_jaro_winkler(name_a.lower(), name_b.lower()) + 0.3 * close


def frame(spark, products, source):
    data = [(n, "c", 1.0, None if p is None else Decimal(str(p)), Decimal("9"), source) for n, p in products]
    return spark.createDataFrame(data, SCHEMA)


def random_products(rng, n):
    words = ["small", "Ring", "bolt", "café", "x", "😀😀", "hub", "zz", "RED", "q7"]
    names = [" ".join(rng.choices(words, k=rng.randint(1, 3))) for _ in range(n)] + ["", "a", None]
    prices = [rng.choice([rng.randint(-3, 30), 10, 10.5, 0, None]) for _ in names]
    return list(zip(names, prices))


def brute_force(left, right, threshold):
    known_a = [(n, float(p)) for n, p in left if n is not None and p is not None]
    known_b = [(n, float(p)) for n, p in right if n is not None and p is not None]
    pairs = [(a, b) for a in known_a for b in known_b if score(*a, *b) >= threshold]
    return {a for a, _ in pairs}, {b for _, b in pairs}, pairs


def matched(df, source):
    return {(r["name"], float(r["discount_price"])) for r in df.collect() if r["source"] == source}


@pytest.mark.parametrize("threshold", [0.5, 0.7, 0.85, 0.95, 1.0])
def test_members_equal_brute_force(spark, threshold, monkeypatch):
    monkeypatch.setattr(entity, "GROUP_ROWS", 15)
    monkeypatch.setattr(similarity_join, "LANE_ROWS", 10)
    rng = random.Random(int(threshold * 100))
    left, right = random_products(rng, 45), random_products(rng, 40)
    want_a, want_b, _ = brute_force(left, right, threshold)
    found = entity_match(frame(spark, left, "a"), frame(spark, right, "b"), Rule(threshold))
    assert matched(found, "a") == want_a
    assert matched(found, "b") == want_b
    assert len(rows(found)) == len(set(rows(found)))


@pytest.mark.parametrize("threshold", [0.6, 0.93, 0.97])
@pytest.mark.parametrize("ranked", [0, 3, 256])
def test_pairs_equal_brute_force(spark, threshold, ranked, monkeypatch):
    monkeypatch.setattr(similarity_join, "RANKED_TOKENS", ranked)
    monkeypatch.setattr(similarity_join, "LANE_ROWS", 10)
    rng = random.Random(7)
    left, right = random_products(rng, 60), random_products(rng, 60)
    left += [("small ring brand#7", 100.0), ("small ring brand#7", 100.0)]
    right += [("Small ring by brand#7", 95.0), ("small rings brand#7", 99.0)]
    _, _, pairs = brute_force(left, right, threshold)
    want = {(a[0].lower(), a[1], b[0].lower(), b[1]) for a, b in pairs}
    found = entity_match_pairs(frame(spark, left, "a"), frame(spark, right, "b"), Rule(threshold))
    got = [(r["name_a"], r["price_a"], r["name_b"], r["price_b"]) for r in found.collect()]
    assert len(got) == len(set(got))
    assert set(got) == want
    copies = {r["rows_a"] for r in found.collect() if r["name_a"] == "small ring brand#7"}
    assert copies == {2}


def test_threshold_is_inclusive_and_copies_collapse(spark):
    # Same name, and a price similarity of exactly 0: the score is 0.7.
    left = frame(spark, [("Ring", 0.0)] * 3, "a")
    right = frame(spark, [("ring", 5.0), ("ring", 5.0)], "b")
    assert len(rows(entity_match(left, right))) == 2


def test_one_side_empty(spark):
    left = frame(spark, [("Ring", 1.0)], "a")
    assert entity_match(left, left.limit(0)).count() == 0


def test_no_cartesian_product(spark):
    rng = random.Random(1)
    left, right = (frame(spark, random_products(rng, 20), s) for s in "ab")
    for plan in (
        plan_of(entity_match(left, right)),
        plan_of(entity_match_pairs(left, right, Rule(0.95))),
        plan_of(entity_match_pairs(left, right, Rule(0.6))),
    ):
        assert "CartesianProduct" not in plan
        assert "NestedLoop" not in plan


@pytest.mark.parametrize("threshold", [0.6, 0.9])
def test_text_only_rule(spark, threshold):
    rng = random.Random(11)
    links = [["".join(rng.choices("img/ab1.", k=rng.randint(0, 9))) for _ in range(40)] for _ in "ab"]
    a, b = (spark.createDataFrame([(x,) for x in side], "image string") for side in links)
    rule = Rule(threshold, 1.0, 0.0, "image", None)
    pairs = [(x, y) for x in links[0] for y in links[1] if reference_jaro_winkler(x, y) >= threshold]
    found = [r["image"] for r in entity_match(a, b, rule).collect()]
    assert sorted(found) == sorted([*{x for x, _ in pairs}, *{y for _, y in pairs}])
    got = {(r["name_a"], r["name_b"]) for r in entity_match_pairs(a, b, rule).collect()}
    assert got == set(pairs)


def test_window_tasks_stay_small(spark, monkeypatch):
    """Links share their first letters and have no price: one block of all of them."""
    monkeypatch.setattr(entity, "GROUP_ROWS", 100)
    data = [(side, f"img/{i}.jpg", 0.0) for i in range(1_000) for side in "ab"]
    keys = spark.createDataFrame(data, "side string, name string, price double")
    rule = Rule(0.6, 1.0, 0.0, name="link", price=None)
    tried = entity._near_price_hits(keys, rule).select(F.spark_partition_id().alias("part"))
    sizes = [r["count"] for r in tried.groupBy("part").count().collect()]
    assert sum(sizes) == 4 * len(data)
    assert max(sizes) < 5 * entity.GROUP_ROWS

import random

import pytest
from conftest import rows
from hypothesis import given, settings
from hypothesis import strategies as st

from tradeweave.functions import (
    indel_ratio,
    jaro_winkler,
    matches_like,
    matches_regex,
    price_similarity,
    price_to_number,
    register_similarity,
)
from tradeweave.functions.similarity import indel_pairs, jaro_winkler_pairs

NAMES = st.text(alphabet="abcé #😀1", max_size=12)


@pytest.mark.parametrize(
    "text, number",
    [
        ("₹1,299", 1299.0),
        ("499", 499.0),
        (" 12.50 ", 12.5),
        ("-3", -3.0),
        ("n/a", None),
        ("NaN", None),
        ("Infinity", None),
        ("12d", None),
        ("", None),
        (None, None),
    ],
)
def test_price_to_number(spark, text, number):
    df = spark.createDataFrame([(text,)], "p string").select(price_to_number("p"))
    assert df.first()[0] == number


def test_price_similarity_branches(spark):
    pairs = [(10.0, 8.0), (5.0, 5.0), (0.0, 0.0), (-2.0, -9.0), (4.0, -2.0), (None, 1.0), (None, None)]
    df = spark.createDataFrame(pairs, "a double, b double")
    found = [r[0] for r in df.select(price_similarity("a", "b")).collect()]
    assert found == [0.8, 1.0, 1.0, 1.0, -0.5, None, None]


def test_like_and_regex(spark):
    df = spark.createDataFrame([("Sony A.1",), ("my sony",), ("a1",), (None,)], "n string")
    assert [r[0] for r in df.where(matches_like("n", "Sony%")).collect()] == ["Sony A.1"]
    assert df.where(matches_like("n", "SONY")).count() == 2
    assert df.where(matches_regex("n", "%a.1%")).count() == 1
    assert df.where(matches_regex("n", "^a")).count() == 1


def test_jaro_winkler_known_values():
    pairs = [("martha", "marhta", 0.961111), ("dixon", "dicksonx", 0.813333), ("", "", 1.0),
             ("", "a", 0.0), ("a", "a", 1.0), ("café", "cafe", 0.883333), ("abc", "xyz", 0.0)]
    scores = jaro_winkler_pairs([p[0] for p in pairs], [p[1] for p in pairs])
    assert [round(s, 6) for s in scores] == [p[2] for p in pairs]


def reference_jaro_winkler(a: str, b: str) -> float:
    if not a and not b:
        return 1.0
    reach = max(max(len(a), len(b)) // 2 - 1, 0)
    taken, left = set(), []
    for i, ch in enumerate(a):
        for j in range(max(0, i - reach), min(len(b), i + reach + 1)):
            if j not in taken and b[j] == ch:
                taken.add(j)
                left.append(ch)
                break
    m = len(left)
    if not m:
        return 0.0
    moved = sum(x != b[j] for x, j in zip(left, sorted(taken))) // 2
    jaro = (m / len(a) + m / len(b) + (m - moved) / m) / 3
    lead = 0
    while lead < min(4, len(a), len(b)) and a[lead] == b[lead]:
        lead += 1
    return jaro + 0.1 * lead * (1 - jaro) if jaro > 0.7 else jaro


@settings(max_examples=300, deadline=None)
@given(st.lists(st.tuples(NAMES, NAMES), min_size=1, max_size=8))
def test_jaro_winkler_matches_textbook(pairs):
    a, b = [p[0] for p in pairs], [p[1] for p in pairs]
    for score, x, y in zip(jaro_winkler_pairs(a, b), a, b):
        assert abs(score - reference_jaro_winkler(x, y)) < 1e-12
        assert 0 <= score <= 1 + 1e-12
        assert score == 1 or x != y


def lcs(a: str, b: str) -> int:
    row = [0] * (len(b) + 1)
    for ch in a:
        before = 0
        for j, other in enumerate(b, start=1):
            before, row[j] = row[j], before + 1 if ch == other else max(row[j], row[j - 1])
    return row[-1]


@settings(max_examples=300, deadline=None)
@given(NAMES, NAMES)
def test_indel_matches_lcs(a, b):
    expected = 2 * lcs(a, b) / (len(a) + len(b)) if a or b else 1.0
    assert indel_pairs([a], [b])[0] == expected
    assert indel_pairs([b], [a])[0] == expected


def test_udfs_keep_nulls_and_work_from_sql(spark):
    random.seed(3)
    data = [(None, "a"), ("a", None), ("ab", "ab"), ("ab", "ba")]
    df = spark.createDataFrame(data, "a string, b string")
    assert [r[0] for r in df.select(jaro_winkler("a", "b")).collect()][:3] == [None, None, 1.0]
    assert [r[0] for r in df.select(indel_ratio("a", "b")).collect()] == [None, None, 1.0, 0.5]
    register_similarity(spark)
    df.createOrReplaceTempView("name_pairs")
    assert rows(spark.sql("SELECT indel_ratio(a, b) FROM name_pairs WHERE a = 'ab'")) == [(0.5,), (1.0,)]


def test_indel_of_long_and_mixed_lengths():
    rng = random.Random(4)
    sizes = [0, 1, 2, 63, 64, 65, 128, 200]
    pairs = [["".join(rng.choices("ab é😀", k=rng.choice(sizes))) for _ in "xy"] for _ in range(60)]

    def common(x, y):
        row = [0] * (len(y) + 1)
        for ch in x:
            last = 0
            for at, other in enumerate(y, 1):
                last, row[at] = row[at], last + 1 if ch == other else max(row[at], row[at - 1])
        return row[-1]

    want = [2 * common(x, y) / (len(x) + len(y)) if x or y else 1.0 for x, y in pairs]
    assert indel_pairs(*map(list, zip(*pairs))) == pytest.approx(want)

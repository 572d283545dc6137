import math
import re
from collections import Counter

from conftest import rows
from test_functions import reference_jaro_winkler

from tradeweave.operators import ranking, tfidf_rank


def brute_force(query, names):
    docs = [Counter(re.findall(r"\b\w\w+\b", n.lower())) for n in [query, *names]]
    df = Counter(t for d in docs for t in d)
    vectors = []
    for d in docs:
        v = {t: n * (math.log((1 + len(docs)) / (1 + df[t])) + 1) for t, n in d.items()}
        norm = math.sqrt(sum(w * w for w in v.values()))
        vectors.append({t: w / norm for t, w in v.items()} if norm else {})
    cosines = [sum(w * vectors[0].get(t, 0) for t, w in v.items()) for v in vectors[1:]]
    return sorted(
        (n, round(c, 9), round(reference_jaro_winkler(query, n), 9)) for n, c in zip(names, cosines)
    )


def check(spark, query, names):
    df = spark.createDataFrame([(n,) for n in [*names, names[0], None]], "n string")
    found = tfidf_rank(df, "n", query).collect()
    assert sorted((r[0], round(r[1], 9), round(r[2], 9)) for r in found) == brute_force(query, names)
    assert all(r[3] == max(r[1], r[2]) for r in found)


def test_rank_equals_brute_force(spark, monkeypatch):
    names = ["red ring", "Ring ring café", "blue bolt", "x", "bolt of red cloth", "ring"]
    check(spark, "Ring red unseen", names)
    check(spark, "a", names)
    monkeypatch.setattr(ranking, "FREQUENT", 4)
    check(spark, "red bolt", names)


def test_rows_are_distinct(spark):
    df = spark.createDataFrame([("a b",)] * 3, "n string")
    assert len(rows(tfidf_rank(df, "n", "zz"))) == 1

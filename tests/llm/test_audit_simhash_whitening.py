"""Filter audit, SimHash join and embedding whitening against brute force."""

import collections
import itertools
import random
import re

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from conftest import plan_of
from oracle_check import compare, oracle_connection

from tradeweave.llm import filter_audit, simhash, whitening
from tradeweave.llm import queries as llm_queries

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
CLASHES = ("part", "mask", "digest", "n", "first", "fp", "rep", "cell", "x", "whitened", "i", "j", "id", "lane", "good")


def with_clashes(frame):
    return frame.withColumns({c: F.lit("clash") for c in CLASHES})


# --- filter audit -----------------------------------------------------------


def audit_rows():
    rng = random.Random(3)
    vocabulary = [f"word{i}" for i in range(60)] + ["A", "UPPER", "é", "#tag", "a|b"]
    rows = [(0, None, "en"), (1, "", "en"), (2, "", None), (3, " \t\n ", ""), (4, "é" * 500, "de")]
    for i in range(5, 90):
        n = rng.choice([1, 40, 99, 100, 101, 130])
        words = [f"w{k}" for k in range(n)] if i % 3 == 0 else [rng.choice(vocabulary) for _ in range(n)]
        rows.append((i, " ".join(words), rng.choice(["en", "de", None])))
    rows += [(100 + i, rng.choice(rows[:40])[1], rng.choice(["en", "de"])) for i in range(60)]
    rows += [rows[20], rows[20], (20, rows[20][1], "fr"), (None, rows[20][1], "en"), (None, rows[20][1], "en"), (None, "only here", "de")]
    return rows


def audit_by_hand(rows, labels):
    least, good, toxic = {}, set(), set()
    for i, text, _ in rows:
        if i is not None:
            least[text or ""] = min(i, least.get(text or "", i))
    for i, quality, bad in labels:
        if i is not None:
            good |= {i} if quality == 1 else set()
            toxic |= {i} if bad == 1 else set()
    fails = []
    for i, text, lang in rows:
        text = text or ""
        words = WORD.findall(text)
        own = {"A"} if len(words) < 100 else set()
        own |= {"B"} if 100 * len(set(words)) < 80 * len(words) else set()
        own |= {"C"} if 100 * len(re.findall("[A-Z]", text)) > 10 * len(text) else set()
        own |= {"D"} if re.search(r"[#$%&*|]", text) else set()
        own |= {"E"} if i is not None and i > least[text] else set()
        fails.append((lang or "", own, i in good, i in toxic))
    out, total = {}, collections.Counter()
    for part in {f[0] for f in fails}:
        for order in itertools.permutations("ABCDE"):
            for step, own in enumerate(order):
                count = collections.Counter()
                for lang, failed, is_good, is_toxic in fails:
                    if lang == part:
                        gone = bool(failed & set(order[:step]))
                        hit = own in failed
                        count["kept"] += not gone and not hit
                        count["removed"] += not gone and hit
                        count["redundant"] += gone and hit
                        count["unique"] += failed == {own}
                        count["good"] += not gone and hit and is_good
                        count["toxic"] += not gone and hit and is_toxic
                total[part, own] += count["removed"]
                out[part, "".join(order), step + 1] = [count[c] for c in ("kept", "removed", "redundant", "unique", "good", "toxic")]
    return {(*k, *v, total[k[0], k[1][k[2] - 1]]) for k, v in out.items()}


def test_filter_audit(spark):
    rows = audit_rows()
    labels = [(i, int(i % 4 == 0), int(i % 5 == 0)) for i in range(0, 150, 2)] + [(8, 1, 1), (8, None, 0), (None, 1, 1), (9999, 1, 1)]
    docs = with_clashes(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    found = filter_audit.filter_audit(docs, spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))
    assert found.columns == ["part", "filter_order", "step", *filter_audit.COUNTS, "shapley"]
    got = [tuple(r) for r in found.collect()]
    assert len(got) == len(set(got)) == 600 * 4
    assert set(got) == audit_by_hand(rows, labels)


def test_filter_audit_equals_sql(spark):
    found = llm_queries.QUERIES["op11_filter_audit"](spark, SF)
    plan = plan_of(found)
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan and "Python" not in plan
    assert compare(found, oracle_connection(SF), llm_queries.ORACLE["op11_filter_audit"]) is None


def test_filter_audit_of_nothing_and_of_text_ids(spark):
    labels = spark.createDataFrame([("a", 1, 0)], "doc_id string, quality int, toxic int")
    empty = spark.createDataFrame([], "doc_id string, text string, lang string")
    assert filter_audit.filter_audit(empty, labels).count() == 0
    docs = spark.createDataFrame([("a", "x", None), ("b", "x", None), (None, "x", None)], "doc_id string, text string, lang string")
    row = filter_audit.filter_audit(docs, labels).where("filter_order = 'EABCD' and step = 1").first()
    assert (row.part, row.kept, row.removed, row.good_lost) == ("", 2, 1, 0)


# --- SimHash ----------------------------------------------------------------


def fingerprint_by_hand(text):
    words = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    shingles = [" ".join(words[k : k + 3]) for k in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def classes_by_hand(values):
    """Index of the class of each value; values at two differing bits or less are linked."""
    parent = list(range(len(values)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, j in itertools.combinations(range(len(values)), 2):
        if (values[i] ^ values[j]).bit_count() <= 2:
            parent[root(i)] = root(j)
    return [root(i) for i in range(len(values))]


def simhash_rows():
    rng = random.Random(8)
    vocabulary = [f"Wort{i}é" for i in range(80)] + ["İ", "x\x1cy"]
    rows = [(1, None), (2, ""), (3, " \n"), (4, "One"), (5, "one"), (6, "one two"), (7, "a b c"), (8, "!!! \x85 x")]
    base = [" ".join(rng.choice(vocabulary) for _ in range(300)) for _ in range(4)]
    for i in range(9, 80):
        words = rng.choice(base).split(" ")
        for _ in range(rng.choice([0, 1, 1, 2, 6])):
            words[rng.randrange(len(words))] = rng.choice(vocabulary)
        rows.append((i, " ".join(words)))
    return rows + [rows[20], (None, rows[20][1]), (None, "alone here by itself"), (-5, rows[30][1])]


@pytest.mark.parametrize("tile", [simhash.TILE, 1])
def test_simhash_components(spark, monkeypatch, tile):
    monkeypatch.setattr(simhash, "TILE", tile)
    rows = simhash_rows()
    docs = with_clashes(spark.createDataFrame(rows, "doc_id long, text string"))
    values = [fingerprint_by_hand(t) for _, t in rows]
    tops = {}
    for (i, _), c in zip(rows, classes_by_hand(values)):
        tops[c] = i if tops.get(c) is None else tops[c] if i is None else min(i, tops[c])
    expected = collections.Counter((i, f"{v:016x}", tops[c]) for (i, _), v, c in zip(rows, values, classes_by_hand(values)))
    found = collections.Counter(tuple(r) for r in simhash.simhash_components(docs).collect())
    assert found == expected
    assert len(tops) < len(set(values))  # some differ and are linked


@pytest.mark.parametrize("tile", [512, 8, 1])
def test_simhash_links_in_dense_clusters(spark, monkeypatch, tile):
    """Clusters around few centres: cells are cut down to 8 open bits and no link is lost."""
    monkeypatch.setattr(simhash, "TILE", tile)
    rng = random.Random(tile)
    values = set()
    for centre in [rng.getrandbits(64) for _ in range(6)] + [0, (1 << 64) - 1]:
        for flips in (0, 1, 1, 2, 3, 4, 5, 6, 8) * 6:
            values.add(centre ^ sum(1 << b for b in rng.sample(range(64), flips)))
    values = sorted(values)
    own = spark.createDataFrame([(simhash._signed(v), k) for k, v in enumerate(values)], "fp long, rep long")
    edges = [(r.a.rep, r.b.rep) for r in simhash.links(own).collect()]
    assert all((values[a] ^ values[b]).bit_count() <= 64 for a, b in edges)
    import tradeweave.llm.jaccard as jaccard

    found = {r.node.rep: r.top.rep for r in jaccard.components(simhash.links(own)).collect()}
    expected, least = classes_by_hand(values), {}
    for k, c in enumerate(expected):
        least.setdefault(c, k)
    assert {k: found.get(k, k) for k in range(len(values))} == {k: least[c] for k, c in enumerate(expected)}


def test_every_pair_within_reach_shares_a_cell():
    """Two differing bits leave two of four parts equal, at every round of cutting."""
    for children in simhash.levels():
        for mask, finer in list(children.items())[:40]:
            open_bits = [b for b in range(64) if not mask >> b & 1]
            for pair in itertools.combinations(open_bits, 2):
                flipped = sum(1 << b for b in pair)
                assert any(not flipped & m for m in finer)


def test_simhash_of_nothing_and_of_text_ids(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert simhash.simhash_components(empty).count() == 0
    docs = spark.createDataFrame([("b", ""), ("a", None), ("c", "word")], "doc_id string, text string")
    assert {r.doc_id: r.component_id for r in simhash.simhash_components(docs).collect()} == {"a": "a", "b": "a", "c": "c"}


def test_long_texts_count_every_shingle(monkeypatch):
    rng = random.Random(2)
    text = " ".join(rng.choice("abcdefgh") * rng.randint(1, 4) for _ in range(5000))
    expected = fingerprint_by_hand(text)
    monkeypatch.setattr(simhash, "BLOCK", 64)
    assert simhash.fingerprint(text.encode()) % (1 << 64) == expected


# --- whitening --------------------------------------------------------------


def vectors():
    rng = np.random.default_rng(4)
    mix = rng.normal(size=(6, 6))
    rows = [(i, [float(np.float32(v)) for v in rng.normal(size=6) @ mix * 0.1]) for i in range(200)]
    rows += [(1000 + i, rows[7][1]) for i in range(100)]  # copies of one vector
    rows += [(2000, None), (2001, []), (2002, [1.0] * 5), (2003, [1.0, None, 1.0, 1.0, 1.0, 1.0])]
    rows += [(2004, [float("nan")] + [0.0] * 5), (2005, [0.0] * 5 + [float("-inf")]), (None, rows[9][1]), rows[3]]
    rows += [(2006, [-0.0] * 6), (2007, [-0.001] * 6)]
    return rows


def test_whitening(spark):
    rows = vectors()
    frame = with_clashes(spark.createDataFrame(rows, "vec_id long, embedding array<float>"))
    found = whitening.whitening(frame).collect()
    kept = [(i, tuple(int(np.floor(256 * np.float64(np.float32(c)))) for c in v)) for i, v in rows if v and len(v) == 6 and all(c is not None and np.isfinite(c) for c in v)]
    fit = np.array(sorted({x for _, x in kept}), object)
    n, sums = len(fit), fit.sum(axis=0)
    centred = fit.astype(float) - sums.astype(float) / n
    values, axes = np.linalg.eigh(centred.T @ centred / n)
    values, axes = values[::-1], axes[:, ::-1]
    assert collections.Counter((r.vec_id, r.component) for r in found) == collections.Counter((i, c) for i, _ in kept for c in (1, 2, 3, 4))
    sign = {}
    by_key = collections.defaultdict(set)
    for i, x in kept:
        white = (np.array(x) - sums.astype(float) / n) @ axes / np.sqrt(np.maximum(values, 1e-300))
        for c in range(4):
            by_key[i, c + 1].add((sum((n * a - s) ** 2 for a, s in zip(x, sums)), white[c]))
    for r in found:
        (deviation, white) = next(iter(by_key[r.vec_id, r.component]))
        sign.setdefault(r.component, np.sign(white * r.whitened))
        assert r.n == n and int(r.deviation) == deviation
        assert r.whitened * sign[r.component] == pytest.approx(white, abs=1e-8)
        assert r.explained == pytest.approx(values[r.component - 1] / values.sum(), rel=1e-9)
        assert r.identity_error < 1e-9
    assert len({r.identity_error for r in found}) == 1


@pytest.mark.parametrize("size", [1, 300, 1 << 20, 1 << 40, 1 << 62])
def test_scatter_is_exact(size):
    rng = np.random.default_rng(size % 1000)
    x = rng.integers(-size, size, size=(131, 5), dtype=np.int64)
    x[:, 2] = 7  # a dimension without planes
    if size == 1 << 62:
        x[0, 0], x[1, 0] = -(1 << 63), (1 << 63) - 1
    own = np.concatenate([x.astype(object), np.full((131, 1), 1, object)], axis=1)
    assert (whitening.scatter(x) == np.triu(own.T @ own)).all()


def test_huge_entries_stay_exact(spark):
    """Sums of products far beyond a long; deviations beyond 38 digits are null."""
    rows = [(1, [3e12, 1.0]), (2, [-2e12, 5.0]), (3, [1e11, -9.0])]
    found = whitening.whitening(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()
    xs = [[int(256 * c) for c in v] for _, v in rows]
    sums = [sum(c) for c in zip(*xs)]
    expected = {k + 1: sum((3 * a - s) ** 2 for a, s in zip(x, sums)) for k, x in enumerate(xs)}
    assert {r.vec_id: int(r.deviation) for r in found} == expected
    far = [(1, [1e30, 1.0]), (2, [-1e30, 5.0]), (3, [0.0, 7.0])]
    assert {r.vec_id: r.deviation is None for r in whitening.whitening(spark.createDataFrame(far, "vec_id long, embedding array<double>")).collect()} == {1: True, 2: True, 3: False}


def test_whitening_without_variance(spark):
    schema = "vec_id string, embedding array<float>"
    assert whitening.whitening(spark.createDataFrame([], schema)).count() == 0
    assert whitening.whitening(spark.createDataFrame([("a", [1.0, 2.0]), ("b", [1.0, 2.0])], schema)).count() == 0
    line = whitening.whitening(spark.createDataFrame([("a", [0.0, 0.0]), ("b", [1.0, 1.0]), ("c", [1.0, 1.0])], schema)).collect()
    assert sorted((r.vec_id, r.component, r.n, round(abs(r.whitened), 9)) for r in line) == [("a", 1, 2, 1.0), ("b", 1, 2, 1.0), ("c", 1, 2, 1.0)]


def test_whitening_query(spark):
    found = llm_queries.QUERIES["op13_embedding_whitening"](spark, SF)
    assert dict(found.dtypes)["deviation"] == "bigint"
    rows = found.collect()
    assert len(rows) == 4 * spark.read.parquet(f"{SF}/embeddings.parquet").count()
    assert rows[0].identity_error < 1e-4


# --- rows without ids of their own ------------------------------------------


def test_keep_one_keeps_unrelated_rows_of_one_id(spark):
    from tradeweave.llm import jaccard

    rows = [(1, "a b c d e f"), (1, "g h i j k l"), (2, "a b c d e f"), (2, "other words go in here"), (3, "g h i j k l")]
    rows += [(4, ""), (4, ""), (5, None), (6, "m n o p q r"), (6, "m n o p q r"), (None, "g h i j k l"), (None, "s t u v w x"), (None, "s t u v w x")]
    kept = [tuple(r) for r in jaccard.keep_one(spark.createDataFrame(rows, "doc_id long, text string")).collect()]
    expected = [(1, "a b c d e f"), (1, "g h i j k l"), (2, "other words go in here"), (4, ""), (4, ""), (5, None), (6, "m n o p q r")]
    expected += [(None, "s t u v w x")] * 2
    assert collections.Counter(kept) == collections.Counter(expected)


def test_rows_without_ids_are_told_apart(spark, monkeypatch):
    """Texts without id whose short digests meet keep what only the other one repeats."""
    from tradeweave.llm import anchors, recompression, suffix_dedup

    monkeypatch.setattr(anchors, "DIGEST_BITS", 22)
    rng = random.Random(6)
    passage = " ".join(f"w{rng.randrange(900)}" for _ in range(120))
    alone = [" ".join(f"x{k}y{rng.randrange(10**6)}" for _ in range(150)) for k in range(2)]
    rows = [(None, alone[0]), (None, alone[1]), (7, f"start {passage} end"), (None, f"begin {passage} stop")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    keys = anchors.keyed(docs).select("doc").collect()
    assert len({r.doc for r in keys}) == 4
    removed = {r.n_bytes: r.n_removed for r in suffix_dedup.suffix_dedup(docs).collect()}
    assert [removed[len(t)] for t in alone] == [0, 0]
    assert all(removed[len(t)] >= len(passage) for _, t in rows[2:])
    words = [r.n_removed for r in recompression.substring_dedup(docs).collect()]
    assert sorted(words) == [0, 0, 0, 120]
    named = spark.createDataFrame([("a", f"start {passage}"), ("b", f"{passage} stop")], "doc_id string, text string")
    assert all(r.n_removed >= len(passage) for r in suffix_dedup.suffix_dedup(named).collect())

"""The operators against brute force, on whole small tables with awkward rows."""

import base64
import collections
import hashlib
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from oracle_check import compare, oracle_connection

import corpus_pipeline
from tradeweave.llm import queries as llm_queries
from tradeweave.llm import (
    bpe,
    fingerprint,
    jaccard,
    packing,
    quality,
    recompression,
    suffix_dedup,
    token_counts,
    toxicity,
    warc,
)

SF = "/root/testdata/sf0.001"
#: Extra columns with names that operators use themselves.
CLASHES = ("n", "score", "ids", "measures", "row", "digest", "cls", "stratum", "count", "id")


def texts():
    rng = random.Random(5)
    vocabulary = [f"Wort{i}é" for i in range(150)] + ["the", "of", "idiot", "a,b", "x.\ny"]
    base = [" ".join(rng.choice(vocabulary) for _ in range(n)) for n in (1, 4, 5, 19, 20, 60, 150, 400)]
    passage = " ".join(rng.choice(vocabulary) for _ in range(90))
    out = ["", None, " \n\t ", "word", "a a a a a a a a a a a a a a a a a a a a a a a a a a", "abc" * 700, "日本語 текст <|endoftext|> İΣ"]
    out += ["line\n" * 40, "!!! ### $$$ | |", "é" * 500, "\x1c\x85x y"]
    for i in range(60):
        words = rng.choice(base).split(" ")
        for _ in range(rng.choice([0, 0, 1, 3])):
            words[rng.randrange(len(words))] = rng.choice(vocabulary)
        if i % 5 == 0:
            words.insert(rng.randrange(len(words)), passage)
        out.append(" ".join(words))
    return list(enumerate(out))


@pytest.fixture(scope="module")
def docs(spark):
    """Every text, an exact copy of some, a repeated row; columns that clash."""
    rows = texts()
    rows += [(1000 + i, t) for i, t in rows[::7]] + [rows[30]]
    frame = spark.createDataFrame([(i, t, ("en", "de", None)[i % 3]) for i, t in rows], "doc_id long, text string, lang string")
    return frame.withColumns({c: F.lit("clash") for c in CLASHES}).cache(), rows


@pytest.fixture(scope="module")
def labels(spark, docs):
    rows = [(i, 1 - i % 7 // 6, int("idiot" in (t or ""))) for i, t in docs[1]] + [(None, 1, 1), (99_999, None, None)]
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int").cache()


def empty(spark):
    return spark.createDataFrame([], "doc_id long, text string, lang string, n_chars long")


def test_bpe_round_trip(docs):
    from tokenizers import Tokenizer

    own = Tokenizer.from_file(bpe.default_vocabulary())
    found = bpe.decode(bpe.encode(docs[0])).collect()
    by_text = collections.defaultdict(set)
    for r in found:
        by_text[r.doc_id].add((r.n_tokens, bytes(r.ids), r.decoded))
    for i, text in docs[1]:
        ids = own.encode(text or "", add_special_tokens=False).ids
        data = np.array(ids, "<u4").tobytes()
        assert by_text[i] == {(len(ids), data, own.decode(ids, skip_special_tokens=False))}
    assert len(found) == len(docs[1])


def test_long_and_short_merges_agree():
    own = bpe.codec(bpe.default_vocabulary())
    rng = random.Random(1)
    for _ in range(100):
        parts = [own.inner[b] for b in rng.choices(b"abcdethinrou", k=rng.randint(1, 60))]
        assert bpe.merge_short(list(parts), own.ranks_of, own.merged) == bpe.merge_long(list(parts), own.ranks_of, own.merged)


def test_packing(docs):
    from tokenizers import Tokenizer

    own = Tokenizer.from_file(packing.default_vocabulary()[0])
    found = packing.pack(packing.pieces(docs[0], length=250), length=256, max_segments=8, max_loss=250).collect()
    ids = {i: np.array([*own.encode(t or "", add_special_tokens=False).ids, 1], "<u4") for i, t in docs[1]}
    sequences = collections.defaultdict(list)
    for r in found:
        assert zlib.crc32(ids[r.doc_id][r.start : r.start + r.length]) == r.ids_crc32 and r.doc_tokens == len(ids[r.doc_id])
        sequences[r.sequence_id].append(r)
    assert sum(r.length for r in found) == sum(len(ids[i]) for i, _ in docs[1])
    for rows in sequences.values():
        at = 0
        for r in sorted(rows, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert len(rows) <= 8 and at <= 256
        assert sum(r.length - (r.start == 0) for r in rows) <= 256


def test_token_counts(docs):
    from tokenizers import Tokenizer

    own = Tokenizer.from_file(packing.default_vocabulary()[0])
    own.encode_special_tokens = True
    for rule in token_counts.RULES:
        total = collections.Counter()
        for r in token_counts.section_tokens(docs[0].dropDuplicates(["doc_id"]), rule).collect():
            total[r.doc_id] += r.n_tokens
        for i, t in docs[1]:
            assert total[i] == pytest.approx(len(own.encode(t or "", add_special_tokens=False).ids))
    assert token_counts.allocate(np.array([2, 5, 6]), np.array([3, 6]), "most").tolist() == [1, 2]
    assert token_counts.allocate(np.array([2, 5, 6]), np.array([3, 6]), "start").tolist() == [2, 1]


def windows_removed(data, length):
    seen = collections.Counter(b[k : k + length] for _, b in data for k in range(len(b) - length + 1))
    for i, b in data:
        gone = np.zeros(len(b), bool)
        for k in range(len(b) - length + 1):
            if seen[b[k : k + length]] > 1:
                gone[k : k + length] = True
        yield i, b, gone


@pytest.mark.parametrize("many", [1000, 1])
def test_suffix_dedup(docs, monkeypatch, many):
    monkeypatch.setattr(suffix_dedup, "MANY", many)
    found = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in suffix_dedup.suffix_dedup(docs[0], 100).collect()}
    for i, b, gone in windows_removed([(i, (t or "").encode()) for i, t in docs[1]], 100):
        spans = int(gone[:1].sum() + (gone[1:] & ~gone[:-1]).sum())
        kept = bytes(np.frombuffer(b, np.uint8)[~gone])
        assert found[i] == (len(b), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()), i
    short = {r.doc_id: r for r in suffix_dedup.without_repeats(docs[0], 100).collect()}
    assert short[1].text is None and short[0].score == "clash" and len(short) == len({i for i, _ in docs[1]})


def test_substring_dedup(docs):
    found = {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in recompression.substring_dedup(docs[0]).collect()}
    first = {}
    for i, t in sorted(docs[1], key=lambda r: r[0]):
        words = re.findall(rb"[^\x20\x09-\x0D]+", (t or "").encode())
        gone = np.zeros(len(words), bool)
        for k in range(len(words) - 19):
            if first.setdefault(tuple(words[k : k + 20]), (i, k)) < (i, k):
                gone[k : k + 20] = True
        kept = b" ".join(w for w, g in zip(words, gone) if not g)
        assert found[i] == (len(words), int(gone.sum()), hashlib.sha256(kept).hexdigest()), i


@pytest.mark.parametrize("tile, hot", [(512, 64), (4, 3)])
def test_jaccard_join(docs, monkeypatch, tile, hot):
    monkeypatch.setattr(jaccard, "TILE", tile)
    monkeypatch.setattr(jaccard, "HOT", hot)
    sets = {}
    for i, t in docs[1]:
        words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
        sets[i] = {tuple(words[k : k + 5]) for k in range(max(1, len(words) - 4))} if words else set()
    top = {i: i for i in sets}

    def root(i):
        while top[i] != i:
            i = top[i]
        return i

    for i, a in sets.items():
        for j, b in sets.items():
            if j < i and a and b and 100 * len(a & b) >= 75 * len(a | b):
                x, y = root(i), root(j)
                top[max(x, y)] = min(x, y)
    found = jaccard.jaccard_components(docs[0]).collect()
    assert len(found) == len(docs[1])
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in found} == {i: (len(s), root(i)) for i, s in sets.items()}
    kept = jaccard.keep_one(docs[0]).collect()
    assert sorted(r.doc_id for r in kept) == sorted({root(i) for i in sets})


def test_toxicity(docs, labels, spark):
    found = {r.doc_id: r for r in toxicity.toxicity(docs[0], labels).collect()}
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in found.values())
    assert all(r.held_out == (zlib.crc32(str(i).encode()) % 5 == 0) for i, r in found.items())
    docs_sf = spark.read.parquet(f"{SF}/../sf0.1/documents.parquet")
    marks = spark.read.parquet(f"{SF}/../sf0.1/labels.parquet").where("toxic is not null")
    held = toxicity.toxicity(docs_sf, marks).where("held_out").join(marks, "doc_id").groupBy("toxic").agg(F.avg("predicted")).collect()
    rates = dict(map(tuple, held))
    assert rates[1] > 0.7 and rates[0] < 0.02


def test_quality_rules(docs, labels):
    found = {r.doc_id: r for r in quality.quality_rules(docs[0], labels).collect()}
    for i, t in docs[1]:
        words = re.findall(r"[^\x20\x09-\x0D]+", t or "")
        threes = [tuple(words[k : k + 3]) for k in range(len(words) - 2)]
        counts = collections.Counter(threes)
        repeated = {k + d for k, w in enumerate(threes) if counts[w] > 1 for d in range(3)}
        lines = [x for x in (t or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
        r = found[i]
        assert (r.n_words, r.word_chars, r.n_symbols) == (len(words), len("".join(words)), len(re.findall(r"[#*$%&|<>]", t or "")))
        assert (r.n_dup_lines, r.n_repeat_words) == (len(lines) - len(set(lines)), len(repeated))
        assert r.base_failed == (len(words) < 50 or 100 * len(repeated) > 50 * len(words))
        assert not (r.base_failed and r.kept)
    kept = quality.keep_good(docs[0], labels).collect()
    assert {r.doc_id for r in kept} == {i for i, r in found.items() if r.kept} and all(r.measures == "clash" for r in kept)


def test_binomial_bound():
    assert quality.upper_bound(0, 100, 0.05) == pytest.approx(1 - 0.05 ** (1 / 100), abs=1e-9)
    assert quality.binomial_cdf(2, 5, 0.5) == pytest.approx(0.5)
    assert quality.cutoff(np.zeros(quality.GRID + 1, np.int64), 0.01, 0.05) is None
    safe = np.zeros(quality.GRID + 1, np.int64)
    safe[0], safe[50] = 2000, 3
    assert quality.cutoff(safe, 0.01, 0.001) == 0.0


def test_fingerprints(docs):
    found = collections.defaultdict(list)
    for r in fingerprint.fingerprints(docs[0]).collect():
        found[r.doc_id].append(r)
    order = sorted({i: t or "" for i, t in docs[1]}.items(), reverse=True)
    by_text = {}
    for (i, text), (_, after) in zip(order, order[1:] + order[:1]):
        third = len(text) // 3
        edited = text[: len(text) - third] + after[:third]
        for r in found[i]:
            assert (r.n_chars, r.edited_sha256) == (len(text), hashlib.sha256(edited.encode()).hexdigest())
            assert by_text.setdefault(text, r.fingerprint) == r.fingerprint
            assert 0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1
            assert r.near_edited == 1 or text != edited


def paragraphs(text):
    return set(re.findall(r"[^.,;:!?|\n]{1,80}[.,;:!?|\n]?", text or ""))


def dice(a, b):
    return 2 * len(a & b) / (len(a) + len(b)) if a or b else 1.0


@pytest.mark.parametrize("rounds", [10, 1])
def test_fingerprint_likeness_is_that_of_whole_texts(spark, monkeypatch, rounds):
    """One round of peeling fails in most parts, so that the retries and the exact way decide."""
    monkeypatch.setattr(fingerprint, "ROUNDS", rounds)
    rows = [(i, "".join(f"clause {i // 2} {k if k % 3 else i * 10_000 + k}. " for k in range(n))) for i, n in enumerate([3, 24, 97, 97, 800, 800, 12])]
    rows += [(20, None), (21, ""), (22, "..."), (23, "one")]
    order = sorted(rows, reverse=True)
    found = {r.doc_id: r for r in fingerprint.fingerprints(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    for (i, text), (_, after) in zip(order, order[1:] + order[:1]):
        text, after = text or "", after or ""
        third = len(text) // 3
        edited = text[: len(text) - third] + after[:third]
        assert found[i].near_edited == pytest.approx(dice(paragraphs(text), paragraphs(edited))), i
        assert found[i].near_next == pytest.approx(dice(paragraphs(text), paragraphs(after))), i
        assert (found[i].fingerprint == found[i].edited_fingerprint) == (paragraphs(text) == paragraphs(edited)), i


def test_warc(spark):
    rows = [(1, "u", "<p>é</p>"), (2, "u\r\nX: y", "<p>é</p>"), (3, None, None), (4, "u", ""), (5, "u", "WARC/1.1\r\nX-Boundary: 0\r\n\r\n\r\n\n")]
    rows += [(None, "u", "<p>é</p>"), (None, None, "alone"), (5, "u", "WARC/1.1\r\nX-Boundary: 0\r\n\r\n\r\n\n")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("key", F.lit("clash"))
    found = warc.archive_round_trip(pages).collect()
    largest = {}
    for i, _, html in rows:
        if i is not None:
            largest[html or ""] = max(i, largest.get(html or "", i))
    expected = collections.Counter()
    for i, _, html in rows:
        data = (html or "").encode()
        top = largest.get(html or "")
        first = top is None or top == i
        expected[i, len(data), base64.b32encode(hashlib.sha1(data).digest()).decode(), "response" if first else "revisit", None if first else top] += 1
    assert collections.Counter(map(tuple, found)) == expected


def test_warc_small_payloads_and_reconstruction(spark, tmp_path):
    pages = spark.createDataFrame([(1, "u", "ab"), (2, "u", "ab"), (3, "u", "abcdef"), (4, "u", "abcdef")], "page_id long, url string, html string")
    boundary = warc.write_warc(warc.assign(pages, least_bytes=3), f"{tmp_path}/w")
    headers, payloads = warc.store(warc.read_warc(spark, f"{tmp_path}/w", boundary))
    again = {r.page_id: (r.record_type, r.payload) for r in warc.reconstruct(headers, payloads).collect()}
    assert again == {1: ("response", "ab"), 2: ("response", "ab"), 3: ("revisit", "abcdef"), 4: ("response", "abcdef")}


def test_empty_tables(spark):
    none, labels = empty(spark), spark.createDataFrame([], "doc_id long, quality int, toxic int")
    results = [
        bpe.decode(bpe.encode(none)),
        packing.pack(packing.pieces(none)),
        suffix_dedup.suffix_dedup(none),
        token_counts.section_tokens(none),
        toxicity.toxicity(none, labels),
        jaccard.jaccard_components(none),
        fingerprint.fingerprints(none),
        recompression.substring_dedup(none),
        quality.quality_rules(none, labels),
        warc.archive_round_trip(spark.createDataFrame([], "page_id long, url string, html string")),
    ]
    assert [df.count() for df in results] == [0] * 10


def test_pipeline(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    found = corpus_pipeline.run(spark, SF).collect()
    good = {r.doc_id for r in quality.keep_good(docs, spark.read.parquet(f"{SF}/labels.parquet")).collect()}
    assert found and {r.doc_id for r in found} <= good


@pytest.mark.parametrize("name, stage", corpus_pipeline.STAGES)
def test_stages_take_awkward_and_empty_tables(spark, docs, labels, tmp_path, name, stage):
    labels.write.parquet(f"{tmp_path}/labels.parquet")
    found = stage(spark, docs[0], str(tmp_path))
    assert {r.doc_id for r in found.collect()} <= {i for i, _ in docs[1]}
    if name != "packing":
        assert found.schema.fieldNames() == docs[0].columns
    nulls = spark.createDataFrame([(None, None, None)] * 3, "doc_id long, text string, lang string")
    assert {r.doc_id for r in stage(spark, nulls, str(tmp_path)).collect()} <= {None}
    none = stage(spark, empty(spark), str(tmp_path))
    assert none.count() == 0


def test_jaccard_of_mostly_common_shingles(spark, monkeypatch):
    monkeypatch.setattr(jaccard, "HOT", 4)
    rng = random.Random(9)
    common = [f"c{i}" for i in range(500)]
    rows = []
    for pair in range(12):
        own = [f"p{pair}x{i}" for i in range(rng.choice([40, 300, 500, 800]))]
        rows += [(2 * pair, " ".join(common + own)), (2 * pair + 1, " ".join(common + own[:-30]))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = {r.doc_id: r.component_id for r in jaccard.jaccard_components(docs).collect()}
    assert all(found[2 * p] == found[2 * p + 1] for p in range(12))


def test_jaccard_of_small_sets_and_larger_partners(spark):
    sizes = [(47, 62), (47, 60), (46, 61), (45, 60), (44, 58), (36, 48)] * 60
    rows = []
    for pair, (small, large) in enumerate(sizes):
        words = [f"p{pair}w{i}" for i in range(large + 4)]
        rows += [(2 * pair, " ".join(words)), (2 * pair + 1, " ".join(words[: small + 4]))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = {r.doc_id: r.component_id for r in jaccard.jaccard_components(docs).collect()}
    assert [p for p in range(len(sizes)) if found[2 * p + 1] != 2 * p] == []
    assert jaccard.keep_one(docs).count() == len(sizes)


@pytest.mark.parametrize("name", sorted(llm_queries.ORACLE))
def test_sql_twins(spark, name):
    assert compare(llm_queries.QUERIES[name](spark, SF), oracle_connection(SF), llm_queries.ORACLE[name]) is None


def test_fingerprint_parts(spark):
    """Peeling gives the difference or fails; sets beyond the limit of a sketch are compared exactly."""
    rng = random.Random(5)
    sets = []
    for _ in range(400):
        both = rng.sample(range(1 << 32), rng.randrange(6))
        sets.append((both + rng.sample(range(1 << 32), rng.randrange(9)), both + rng.sample(range(1 << 32), rng.randrange(9))))
    sets.append((list(range(fingerprint.MOST + 40)), list(range(5, fingerprint.MOST + 90))))
    sets.append(([0], [1 << 27]))
    part = lambda c: F.struct(F.col(c).alias("keys"), fingerprint.sketch(F.col(c)).alias("cells"))
    rows = spark.createDataFrame(sets, "x array<long>, y array<long>").select("x", "y", part("x").alias("a"), part("y").alias("b"))
    side = lambda e: ("b" if e < 0 else "a", e & fingerprint.DIGEST)
    peeled = 0
    for r in rows.select("x", "y", fingerprint.peeled(F.col("a.cells"), F.col("b.cells")).alias("p"), fingerprint.differing(F.col("a"), F.col("b")).alias("d")).collect():
        x, y = set(r.x), set(r.y)
        expected = sorted([("a", k) for k in x - y] + [("b", k) for k in y - x])
        assert sorted(map(side, r.d)) == expected
        if r.p is not None:
            peeled += 1
            assert sorted(map(side, r.p)) == expected
    assert peeled > 300


def test_suffix_order_packs_its_first_symbols(monkeypatch):
    """Eight sorts at most for 400 symbols, in the order of the first ones."""
    import numpy as np

    from tradeweave.llm import suffix_dedup

    rng = np.random.default_rng(4)
    text = np.concatenate([rng.integers(0, 3, 900), np.tile(rng.integers(250, 257, 450), 2), [0]]).astype(np.int64)
    sorts = []
    argsort = np.argsort
    monkeypatch.setattr(np, "argsort", lambda *args, **options: sorts.append(1) or argsort(*args, **options))
    order = suffix_dedup.suffix_order(text, 400)
    assert len(sorts) <= 8
    starts = [tuple(text[at : at + 400].tolist()) for at in order]
    assert starts == sorted(starts) and sorted(order.tolist()) == list(range(len(text)))


def test_suffix_expansion_sorts_little(monkeypatch):
    """The transform sorts only ties again and starts at strings of 7 symbols."""
    rng = np.random.default_rng(6)
    base = bytes(rng.integers(97, 123, 736, dtype=np.uint8))
    strings = [base[:k] + bytes([65 + k % 7]) + base[k + 1 :] for k in range(50, 700, 13)]
    strings += [bytes(rng.integers(97, 123, 420, dtype=np.uint8)) for _ in range(60)]
    sorted_rows = []
    argsort = np.argsort
    monkeypatch.setattr(np, "argsort", lambda a, *args, **options: sorted_rows.append(len(a)) or argsort(a, *args, **options))
    found = suffix_dedup.repeated_windows(strings, [1] * len(strings), 400)
    seen = collections.Counter(s[k : k + 400] for s in strings for k in range(len(s) - 399))
    assert [f.tolist() for f in found] == [[k for k in range(len(s) - 399) if seen[s[k : k + 400]] > 1] for s in strings]
    # 11.7 times their symbols before, 3.5 after
    assert sum(sorted_rows) < 6 * sum(map(len, strings))


def test_suffix_strings_are_trimmed_to_what_repeats():
    """What is left of strings that share an anchor holds all repeated windows and little else."""
    rng = np.random.default_rng(7)
    for length in (100, 400):
        texts = []
        for _ in range(12):
            base = bytes(rng.integers(97, 101, 3 * length, dtype=np.uint8))
            for _ in range(int(rng.integers(2, 6))):
                text = bytearray(base)
                for at in rng.integers(0, len(base), int(rng.integers(0, 4))):
                    text[at] = 65 + int(rng.integers(0, 2))
                texts.append(bytes(text))
        # one gram in many texts whose neighbours differ; most strings of this anchor repeat nothing
        gram = bytes(rng.integers(97, 123, suffix_dedup.GRAM, dtype=np.uint8))
        texts += [bytes(rng.integers(97, 123, length, dtype=np.uint8)) + gram + bytes(rng.integers(97, 123, length, dtype=np.uint8)) for _ in range(40)]
        held = collections.defaultdict(lambda: [0, b""])
        for text in texts:
            for start, n, anchor, content in suffix_dedup.byte_runs(text, [(0, len(text))], length):
                own = held[int(anchor), content]
                own[0], own[1] = own[0] + 1, text[start : start + n + length - 1]
        rows = [(a, c, w, b) for (a, c), (w, b) in sorted(held.items())]
        seen = collections.Counter(t[k : k + length] for t in texts for k in range(len(t) - length + 1))
        left = {}
        for group in suffix_dedup.trimmed([r for r in rows for _ in range(2)], length):
            for anchor, content, start, data, w in group:
                assert (anchor, content) not in left and held[anchor, content][0] == w
                left[anchor, content] = (start, start + len(data) - length)
        for anchor, content, _, data in rows:
            twice = [k for k in range(len(data) - length + 1) if seen[data[k : k + length]] > 1]
            low, high = left.get((anchor, content), (0, -1))
            assert all(low <= k <= high for k in twice), (low, high, twice)
            if sum(r[0] == anchor for r in rows) == 2 and held[anchor, content][0] == 1:
                assert twice == list(range(low, high + 1))
        assert sum(high - low + length for low, high in left.values()) < 0.6 * sum(len(r[3]) for r in rows)


def test_suffix_strings_come_from_their_own_text(spark):
    """Of two texts with one id and one short digest, only that with the wanted content is cut."""
    import xxhash

    right, other = "r" * 450, "o" * 300
    content = np.array([xxhash.xxh3_64_intdigest(right[10:430].encode())], np.uint64).view(np.int64)[0]
    texts = spark.createDataFrame([(1, 7, right), (1, 7, other), (2, 7, right)], "doc long, digest long, text string")
    wanted = spark.createDataFrame([(5, int(content), 3, (1, 7, 10, 21))], "anchor long, content long, w long, at struct<doc long, digest long, start long, n long>")
    assert [tuple(r) for r in suffix_dedup.cut_strings(texts, wanted, 400).collect()] == [(5, int(content), 3, right[10:430].encode())]

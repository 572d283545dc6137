"""Document fingerprints as invertible Bloom lookup sketches, in SQL functions only.

A text is a set of paragraphs: stretches cut at punctuation and line breaks, at
most ``PARAGRAPH`` characters long. Each is a 32-bit digest, and every digest
is in the sketch: the set is dealt by a hash over ``2 ** level`` parts of about
``KEEP`` digests. In its part a digest goes into three of ``CELLS`` cells,
which hold a count and the sum of (check, digest) in one long. Two sketches of one level
subtract cell by cell; peeling takes out cells with one digest until none is
left, which recovers the digests that differ. A part where that fails is made
again, dealt over ``2 ** k`` sketches with other cells; where all fail, the
difference of that part is taken from its digests themselves.

Likeness is the Dice coefficient of the two whole sets. The printed fingerprint
is the number of digests and the parts added up, cell by cell: a fixed length,
in which every digest counts. A part of more than ``MOST`` digests, which
dealing by hash makes all but impossible, has no cells: it is compared exactly
and counts in the printed fingerprint by a hash of its digests.

Defined results: null texts are empty, have no paragraphs and are alike (1.0)
only with texts of equal fingerprint; rows that agree in id and text are one
document when the next document is looked for; rows with a null id come last;
a single document is its own next.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tradeweave.llm.common import stored

PARAGRAPH = 80
KEEP = 6
#: Three groups of cells, one for each hash.
CELLS, GROUP = 24, 8
LARGER = (1, 3)
ROUNDS = 10
DIGEST = 0xFFFFFFFF
#: An entry is one long: a count of one, 16 check bits, the digest. 64 of them add up
#: without a carry into the count, and all that peeling subtracts stays within 63 bits.
COUNT, MOST = 54, 64
#: The sign bit of a found entry tells its side.
VALUE, OTHER = (1 << 63) - 1, -(1 << 63)


def _entry(key: Column) -> Column:
    """What a digest adds to its cells."""
    check = F.xxhash64(key, F.lit(7)).bitwiseAND(F.lit(0xFFFF))
    return F.shiftleft(check, 32).bitwiseOR(key).bitwiseOR(F.lit(1 << COUNT))


def _group(j: int, salt: int) -> tuple[Column, Column]:
    """The bits of a digest that place it in group ``j``, and their value for each cell.

    Each ``salt`` takes nine other bits, so digests that share their cells part.
    """
    shift = 9 * salt + 3 * j
    places = ", ".join(f"{p << shift}L" for p in range(GROUP))
    return F.lit((GROUP - 1) << shift).cast("long"), F.expr(f"array({places})")


def _bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` of a value that is made once, by a one-element array."""
    return F.element_at(F.transform(F.array(value), use), 1)


def _once(value: Column) -> Column:
    """``value``, kept whole by the optimizer, which would repeat a plain struct for each field read from it."""
    return _bound(value, lambda x: x)


def digests(text: Column) -> Column:
    """Distinct paragraph digests of a text."""
    parts = F.regexp_extract_all(text, F.lit(rf"[^.,;:!?|\n]{{1,{PARAGRAPH}}}+[.,;:!?|\n]?+"), F.lit(0))
    return F.array_distinct(F.transform(parts, lambda p: F.xxhash64(p).bitwiseAND(F.lit(DIGEST))))


def level_of(keys: Column) -> Column:
    """The level that leaves about ``KEEP`` digests, or fewer, in a part."""
    return F.greatest(F.lit(0), F.ceil(F.log2(F.greatest(F.size(keys), F.lit(1)) / F.lit(KEEP)))).cast("int")


def sketch(keys: Column, salt: int = 0) -> Column:
    """Cells of a set of digests; null if it has more than ``MOST``."""
    zero = F.lit(0).cast("long")

    def cells(own: Column) -> Column:
        def group(j: int) -> Column:
            mask, places = _group(j, salt)
            add = lambda p: F.aggregate(own, zero, lambda a, e: F.when(e.bitwiseAND(mask) == p, a + e).otherwise(a))
            return F.transform(places, add)

        return F.concat(*[group(j) for j in range(CELLS // GROUP)])

    # the entries are made once and not for every cell
    made = _bound(F.transform(keys, _entry), cells)
    return F.when(F.size(keys) == 0, F.array_repeat(zero, CELLS)).when(F.size(keys) <= MOST, made)


def parts_of(keys: Column, level: Column) -> Column:
    """``keys`` and ``cells`` of the parts at a level.

    Dealt by the lower half of the level's bits, then by the upper half, so
    that the work for a digest grows with the root of the number of parts.
    """
    one = F.lit(1 << 32)
    low = F.floor(level / 2).cast("int")
    size = lambda bits: F.call_function("shiftleft", one, bits)
    # masks and the step are made once, not for every digest; the bits that deal stand above the digest
    plan = F.struct((size(low) - one).alias("low"), size(low).alias("step"), (size(level) - size(low)).alias("high"))

    def parts(by: Column) -> Column:
        dealt = F.transform(keys, lambda k: F.shiftleft(F.xxhash64(k, F.lit(9)).bitwiseAND(F.lit(0x7FFFFFFF)), 32).bitwiseOR(k))
        places = F.sequence(F.lit(0).cast("long"), by.low, one)
        groups = _bound(dealt, lambda every: F.transform(places, lambda p: F.filter(every, lambda e: e.bitwiseAND(by.low) == p)))
        own = lambda group, q: F.transform(F.filter(group, lambda e: e.bitwiseAND(by.high) == q), lambda e: e.bitwiseAND(F.lit(DIGEST)))
        dealt_again = lambda group: F.transform(F.sequence(F.lit(0).cast("long"), by.high, by["step"]), lambda q: own(group, q))
        return F.transform(F.flatten(F.transform(groups, dealt_again)), lambda k: F.struct(k.alias("keys"), sketch(k).alias("cells")))

    return _bound(plan, parts)


def peeled(a: Column, b: Column, salt: int = 0) -> Column:
    """Entries of digests in one sketch only, with the sign bit for ``b``; null if peeling fails."""
    difference = F.zip_with(a, b, lambda x, y: x - y)
    count = CELLS // GROUP
    names = [f"g{j}" for j in range(count)]

    def state(groups: list[Column], found: Column, more: bool) -> Column:
        return F.struct(*[g.alias(n) for g, n in zip(groups, names)], found.alias("found"), F.lit(more).alias("more"))

    def pure(x: Column) -> Column:
        m = F.abs(x)
        return (F.call_function("shiftright", m, F.lit(COUNT)) == 1) & (_entry(m.bitwiseAND(F.lit(DIGEST))) == m)

    def take(s: Column) -> Column:
        groups = [s[n] for n in names]
        # a digest may be alone in several of its cells
        side = lambda x: F.when(x < 0, (-x).bitwiseOR(F.lit(OTHER))).otherwise(x)
        alone = F.array_distinct(F.transform(F.filter(F.concat(*groups), pure), side))

        def rest(gone: Column, j: int) -> Column:
            mask, places = _group(j, salt)
            taken = lambda y, e: F.when(e < 0, y + e.bitwiseAND(F.lit(VALUE))).otherwise(y - e)
            out = lambda y, e, p: F.when(e.bitwiseAND(mask) == p, taken(y, e)).otherwise(y)
            return F.zip_with(groups[j], places, lambda x, p: F.aggregate(gone, x, lambda y, e: out(y, e, p)))

        def after(gone: Column) -> Column:
            made = state([rest(gone, j) for j in range(count)], F.concat(s.found, gone), True)
            return F.when(F.size(gone) > 0, made).otherwise(state(groups, s.found, False))

        return _bound(alone, after)

    def start(cells: Column) -> Column:
        return state([F.slice(cells, 1 + j * GROUP, GROUP) for j in range(count)], F.array().cast("array<bigint>"), True)

    def step(s: Column, _: Column) -> Column:
        return F.when(s.more, take(s)).otherwise(s)

    def finish(s: Column) -> Column:
        # a sum taken for an entry by its check bits is found a second time, when it is put back
        once = F.size(F.array_distinct(F.transform(s.found, lambda e: e.bitwiseAND(F.lit(VALUE))))) == F.size(s.found)
        return F.when(~F.exists(F.concat(*[s[n] for n in names]), lambda x: x != 0) & once, s.found)

    return F.aggregate(F.sequence(F.lit(1), F.lit(ROUNDS)), _bound(difference, start), step, finish)


def _exact(a: Column, b: Column) -> Column:
    """The same from the digests themselves."""
    return F.concat(F.transform(F.array_except(a, b), _entry), F.transform(F.array_except(b, a), lambda k: _entry(k).bitwiseOR(F.lit(OTHER))))


def differing(a: Column, b: Column) -> Column:
    """Differing digests of two parts, as ``peeled`` gives them: by peeling, by larger sketches with other cells, or exactly."""
    tries = [peeled(a.cells, b.cells)]
    for salt, k in enumerate(LARGER, 1):
        deal = lambda keys, p: F.filter(keys, lambda x: F.pmod(F.xxhash64(x, F.lit(11)), F.lit(1 << k)) == p)  # noqa: B023,E731
        parts = F.transform(
            F.sequence(F.lit(0), F.lit((1 << k) - 1)),
            lambda p: peeled(sketch(deal(a["keys"], p), salt), sketch(deal(b["keys"], p), salt), salt),  # noqa: B023
        )
        tries.append(_bound(parts, lambda made: F.when(~F.exists(made, F.isnull), F.flatten(made))))
    # equal cells subtract to nothing, so there is nothing to peel
    none = F.array().cast("array<bigint>")
    return F.when(a.cells == b.cells, none).otherwise(F.coalesce(*tries, _exact(a["keys"], b["keys"])))


def likeness(a: Column, b: Column) -> Column:
    """Dice coefficient from two sketches (structs of level, keys and parts)."""
    level = F.greatest(a.level, b.level)
    at_level = lambda s: F.when(s.level == level, s.parts).otherwise(parts_of(s["keys"], level))
    counts = F.zip_with(
        at_level(a),
        at_level(b),
        lambda x, y: _bound(differing(x, y), lambda found: F.struct(F.size(found).alias("all"), F.size(F.filter(found, lambda f: f > 0)).alias("one"))),
    )
    start = F.struct(F.lit(0).alias("all"), F.lit(0).alias("one"))
    total = F.aggregate(counts, start, lambda s, x: F.struct((s["all"] + x["all"]).alias("all"), (s.one + x.one).alias("one")))

    def dice(t: Column) -> Column:
        common = F.size(a["keys"]) - t.one
        return F.coalesce(F.try_divide(2.0 * common, 2.0 * common + t["all"]), F.lit(1.0))

    return _bound(total, dice)


def fingerprint(s: Column) -> Column:
    """Number of digests and the added cells as hex: 8 digits, then 8 + 16 for each cell."""
    cell = lambda c, v: F.struct(c.alias("c"), v.alias("v"))
    empty = F.array_repeat(cell(F.lit(0).cast("long"), F.lit(0).cast("long")), CELLS)
    value = (1 << 62) - 1
    # a part beyond the limit of a sketch counts by a hash of its digests
    whole = lambda p: F.coalesce(p.cells, F.array_repeat(F.xxhash64(F.array_sort(p["keys"])).bitwiseAND(F.lit((1 << COUNT) - 1)), CELLS))

    def plus(x: Column, y: Column) -> Column:
        count = F.call_function("shiftright", y, F.lit(COUNT))
        return cell(x.c + count, (x.v + y.bitwiseAND(F.lit((1 << COUNT) - 1))).bitwiseAND(F.lit(value)))

    added = F.aggregate(s.parts, empty, lambda own, p: F.zip_with(own, whole(p), plus))
    cells = F.transform(added, lambda x: F.concat(F.lpad(F.hex(x.c), 8, "0"), F.lpad(F.hex(x.v), 16, "0")))
    return F.concat(F.lpad(F.hex(F.size(s["keys"])), 8, "0"), F.array_join(cells, ""))


def with_parts(keys: Column, *partners: Column) -> Column:
    """The sketch of a set, at the level of the largest of it and its partners."""
    level = F.greatest(*[level_of(k) for k in (keys, *partners)]) if partners else level_of(keys)
    return F.struct(level.alias("level"), keys.alias("keys"), parts_of(keys, level).alias("parts"))


def neighbours(ids: DataFrame) -> DataFrame:
    """``doc, digest, third`` and the key of the next document, ``next_doc, next_digest``.

    ``ids`` has ``doc``, ``digest`` and ``n_chars``, a row per document. Rows
    are dealt by range; inside a range a window finds the next one, and the
    first rows of the ranges (one for each partition) supply the rest.
    """
    order = [F.col("doc").desc_nulls_last(), F.col("digest")]
    ranged = stored(ids.repartitionByRange(*order).withColumn("part", F.spark_partition_id()), "fingerprint-order")
    inside = W.partitionBy("part").orderBy(*order)
    key = F.struct("doc", "digest")
    rows = ranged.withColumns({"after": F.lead(key).over(inside), "place": F.row_number().over(inside)})
    firsts = stored(rows.where("place = 1").select("part", key.alias("first")), "fingerprint-firsts")
    # as many rows as partitions: one window and a broadcast are bounded by that number
    ends = W.orderBy("part").rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    heads = firsts.select(
        F.col("part").alias("of"), F.coalesce(F.lead("first").over(W.orderBy("part")), F.first("first").over(ends)).alias("head")
    )
    joined = rows.join(F.broadcast(heads), F.col("part") == F.col("of"))
    after = F.coalesce("after", "head")
    return joined.select(
        F.col("doc").alias("of_doc"),
        F.col("digest").alias("of_digest"),
        F.floor(F.col("n_chars") / 3).cast("int").alias("third"),
        after["doc"].alias("next_doc"),
        after["digest"].alias("next_digest"),
    )


def fingerprints(docs: DataFrame) -> DataFrame:
    """Fingerprints of every document and of its edited text, and their likeness."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select(F.col("doc_id").alias("doc"), text.alias("text")).withColumn("digest", F.xxhash64("text"))
    ids = docs.select(F.col("doc_id").alias("doc"), F.xxhash64(text).alias("digest"), F.char_length(text).alias("n_chars")).distinct()
    pairs = neighbours(ids)
    # rows that agree in id and text are one document here, as they are in `pairs`
    heads = (
        rows.join(pairs, F.col("doc").eqNullSafe(F.col("next_doc")) & (F.col("digest") == F.col("next_digest")))
        .select("of_doc", "of_digest", "third", F.expr("left(text, third)").alias("head"), digests(F.col("text")).alias("other"))
        .dropDuplicates(["of_doc", "of_digest"])
    )
    joined = rows.join(heads, F.col("doc").eqNullSafe(F.col("of_doc")) & (F.col("digest") == F.col("of_digest")))
    edited = F.concat(F.expr("left(text, char_length(text) - third)"), "head")
    made = joined.select(
        F.col("doc").alias("doc_id"),
        F.char_length("text").cast("long").alias("n_chars"),
        F.sha2(edited, 256).alias("edited_sha256"),
        _once(F.struct(digests(F.col("text")).alias("own"), digests(edited).alias("edit"), "other")).alias("s"),
    )
    sets = {"a": with_parts(F.col("s.own")), "b": with_parts(F.col("s.edit")), "d": with_parts(F.col("s.other"), F.col("s.own"))}
    built = made.withColumns({name: _once(s) for name, s in sets.items()})
    return built.select(
        "doc_id",
        "n_chars",
        "edited_sha256",
        fingerprint(F.col("a")).alias("fingerprint"),
        fingerprint(F.col("b")).alias("edited_fingerprint"),
        likeness(F.col("a"), F.col("b")).alias("near_edited"),
        likeness(F.col("a"), F.col("d")).alias("near_next"),
    )

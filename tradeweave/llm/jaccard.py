"""N-gram Jaccard join: documents whose sets of five-word shingles are alike.

1. One pass makes each document's set of hashed shingles and gives its size, a
   128-bit digest and its ``LOW`` smallest hashes. Documents of equal sets are
   one class from here on; copies are folded before anything is shuffled.
2. Classes that share a low shingle may link. The hashes are a random order, so
   two sets with similarity 0.75 share none of their ``NEED`` lowest with
   probability at most 4 ** -NEED (4e-15), the size of a hash collision.
   For the same reason a class of which fewer than ``REPEATED`` low shingles
   occur elsewhere has no partner (probability 3e-15). Small sets, whose low
   shingles are all, must share three in four, less what a larger partner does
   not list; that bound is exact. Shingles of more than ``HOT``
   classes are passed over in favour of the next ones, and of as many more as
   were passed over: what two sets share may be mostly hot. A class with more
   than ``PASSED`` hot ones keeps them all (probability below 1e-11 in any mix).
3. Each low shingle has a hub, one of its classes. The classes that share a
   shingle with a hub form its tiles, one for each band of set sizes.
4. In a tile, hashed bitmap signatures bound the overlap of two sets from above
   by bit counts; what passes is intersected exactly as sorted arrays. Classes
   already known to be in one component are not compared again.
   Tiles beyond ``TILE`` classes are cut into blocks. Blocks first meet the
   hub; only classes that did not join it meet all the other blocks.
5. Components come from star contraction over the links.

Defined results: null and empty texts have an empty set and are linked with
nothing; fewer than five words are one shingle; repeated rows are one class;
rows with a null id are counted in sets but never name a component; rows that
repeat an id with different texts are different documents.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from tradeweave.llm.common import raw_bytes, sliced, stored
from tradeweave.llm.words import WordHashes, mixed

N = 5
#: Similarity as a fraction: 75 of 100.
SHARE, OF = 75, 100
LOW, NEED = 48, 24
REPEATED = 10
HOT = 64
PASSED = 14
TILE = 512
#: Ratio of the largest to the smallest set of a band.
BAND = 4
#: Words of 64 bits in a signature.
SIGNATURE = 32
FACTOR = np.uint64(0x9E3779B97F4A7C15)


def shingles(hashes: WordHashes, text: bytes) -> np.ndarray:
    """Sorted distinct shingle hashes."""
    words = hashes.of(text.lower().split())  # bytes: only A-Z change, only ASCII white space cuts
    if not len(words):
        return words
    size = min(N, len(words))
    count = len(words) - size + 1
    value = np.full(count, size, np.uint64)
    for i in range(size):
        value = (value ^ words[i : i + count]) * FACTOR
        value ^= value >> np.uint64(31)
    return np.unique(mixed(value))


def digest(own: np.ndarray) -> bytes | None:
    return xxhash.xxh3_128_digest(own.tobytes()) if len(own) else None


def signed(values: np.ndarray) -> np.ndarray:
    return values.view(np.int64)


def mark(docs: DataFrame) -> Column:
    """Tells rows of one id apart by their texts."""
    return F.xxhash64(F.coalesce(docs["text"].cast("string"), F.lit("")))


def sets(docs: DataFrame) -> DataFrame:
    """``doc_id, mark, n, cls, low``: hash of the text, size, digest (null: empty) and lowest shingles."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for batch in sliced(batches, "text"):
            all_sets = [shingles(hashes, x) for x in raw_bytes(batch, "text")]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    batch.column("mark"),
                    pa.array([len(s) for s in all_sets], pa.int64()),
                    pa.array([digest(s) for s in all_sets], pa.binary()),
                    pa.array([signed(s[:LOW]) for s in all_sets], pa.list_(pa.int64())),
                ],
                ["doc_id", "mark", "n", "cls", "low"],
            )

    rows = docs.select("doc_id", F.col("text").cast("string"), mark(docs).alias("mark"))
    return rows.mapInArrow(run, f"doc_id {kind}, mark long, n long, cls binary, low array<long>")


def whole_sets(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """``cls, set`` (sorted hashes as bytes) of the wanted classes (``cls, rep``)."""
    # wanted classes grow with the input, so they are not left to be broadcast while they happen to be few
    rows = docs.select("doc_id", F.col("text").cast("string")).join(wanted.hint("merge"), F.col("doc_id") == F.col("rep"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for batch in sliced(batches, "text"):
            own, out = batch.column("cls").to_pylist(), []
            for expected, text in zip(own, raw_bytes(batch, "text")):
                found = shingles(hashes, text)
                # an id may stand on rows of several texts
                out.append(found.tobytes() if digest(found) == expected else None)
            yield pa.RecordBatch.from_arrays([batch.column("cls"), pa.array(out, pa.binary())], ["cls", "set"])

    return rows.select("cls", "text").mapInArrow(run, "cls binary, set binary").where("set is not null")


def tiles(classes: DataFrame) -> DataFrame:
    """``hub, band, cls, rep, n``: the classes to compare with one another."""
    low = classes.select("cls", "rep", "n", F.size("low").alias("held"), F.posexplode("low").alias("pos", "shingle"))
    repeated = stored(low.groupBy("shingle").count().where("count > 1"), "jaccard-repeated")
    known = low.join(repeated, "shingle").withColumn("hot", (F.col("count") > HOT).cast("int"))
    own = W.partitionBy("cls")
    ranked = known.withColumns(
        {"hot_before": F.sum("hot").over(own.orderBy("pos")), "hot_all": F.sum("hot").over(own)}
    )
    repeats = F.count("*").over(own)
    # a partner of up to held * OF / SHARE shingles lists LOW of them: all that it leaves out may be shared
    listed = SHARE * repeats >= SHARE * LOW - (OF - SHARE) * F.col("held")
    enough = F.when(F.col("held") < LOW, (OF * repeats >= SHARE * F.col("held")) | listed).otherwise(repeats >= REPEATED)
    ranked = ranked.withColumn("enough", enough).where("enough")
    few = (F.col("held") - F.col("hot_all") < NEED) | (F.col("hot_all") > PASSED)
    cold_place = F.col("pos") - F.col("hot_before")
    kept = stored(
        ranked.where(few | (F.col("hot") == 0) & (cold_place < NEED + F.col("hot_all"))).select("shingle", "cls", "rep", "n"),
        "jaccard-low",
    )
    hubs = (
        kept.groupBy("shingle")
        .agg(F.min(F.struct(F.xxhash64("cls"), "cls", "rep", "n")).alias("hub"), F.count("*").alias("c"))
        .where("c > 1")
        .select("shingle", "hub")
    )
    members = kept.join(stored(hubs, "jaccard-hubs"), "shingle").select("hub.cls", "cls", "rep", "n").toDF("hub", "cls", "rep", "n").distinct()
    # half a shingle keeps whole numbers off the edges of bands
    band = F.floor(F.log(F.col("n") + 0.5) / math.log(BAND)).cast("int")
    # the largest of a band also join the next one, so every pair of similar sizes meets
    near = OF * F.col("n") >= SHARE * F.pow(F.lit(float(BAND)), band + 1)
    placed = members.withColumn("band", F.explode(F.when(near, F.array(band, band + 1)).otherwise(F.array(band))))
    sized = placed.groupBy("hub", "band").agg(F.count("*").alias("m")).where("m > 1")
    return placed.join(stored(sized, "jaccard-sizes"), ["hub", "band"])


class Component:
    """Union-find over the rows of a tile."""

    def __init__(self, size: int):
        self.parent = list(range(size))

    def root(self, i: int) -> int:
        while self.parent[i] != i:
            self.parent[i] = i = self.parent[self.parent[i]]
        return i

    def join(self, i: int, j: int) -> None:
        self.parent[self.root(i)] = self.root(j)


def signatures(all_sets: list[np.ndarray]) -> np.ndarray:
    out = np.zeros((len(all_sets), SIGNATURE * 64), bool)
    for row, own in zip(out, all_sets):
        row[(own % np.uint64(SIGNATURE * 64)).astype(np.int64)] = True
    return np.packbits(out, axis=1).view(np.uint64)


def compare(all_sets: list[np.ndarray], right: list[bool] | None = None) -> Component:
    """Components of a tile. With ``right``, only pairs of two sides are compared."""
    sizes = np.array([len(s) for s in all_sets])
    found = Component(len(all_sets))
    order = np.argsort(sizes, kind="stable")
    bits = signatures(all_sets) if len(all_sets) > 3 else None
    side = np.array(right) if right is not None else None
    for at in range(1, len(order)):
        i = int(order[at])
        earlier = order[:at]
        earlier = earlier[OF * sizes[earlier] >= SHARE * sizes[i]]
        if side is not None:
            earlier = earlier[side[earlier] != side[i]]
        # overlap that the similarity asks for
        need = -(-SHARE * (sizes[earlier] + sizes[i]) // (OF + SHARE))
        if bits is not None and len(earlier):
            alone = np.bitwise_count(bits[earlier] & ~bits[i]).sum(axis=1, dtype=np.int64)
            alone_too = np.bitwise_count(bits[i] & ~bits[earlier]).sum(axis=1, dtype=np.int64)
            bound = np.minimum(sizes[earlier] - alone, sizes[i] - alone_too)
            likely = np.argsort(need - bound, kind="stable")
            likely = likely[bound[likely] >= need[likely]]
            earlier, need = earlier[likely], need[likely]
        for j, least in zip(earlier.tolist(), need.tolist()):
            if found.root(i) != found.root(j):
                if len(np.intersect1d(all_sets[i], all_sets[j], assume_unique=True)) >= least:
                    found.join(i, j)
    return found


LINK = "a struct<rep:bigint,cls:binary>, b struct<rep:bigint,cls:binary>"


def compared(rows: DataFrame, key: list[str], sided: bool = False) -> DataFrame:
    """Links within each group of ``key``, as stars around its least class.

    ``rows`` has ``cls, rep, set`` and, if ``sided``, ``right``.
    """
    dealt = rows.repartition(*key).sortWithinPartitions(*key)
    columns = [*key, "cls", "rep", "set"] + ["right"] * sided
    node = pa.struct([("rep", pa.int64()), ("cls", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def each() -> Iterator[tuple]:
            for batch in batches:
                yield from zip(*[batch.column(c).to_pylist() for c in columns])

        for _, group in groupby(each(), lambda r: r[: len(key)]):
            # the same class may come twice, once on each side
            members = {(r[len(key)], r[-1] if sided else None): r for r in group}
            rows_of = sorted(members.values(), key=lambda r: (r[len(key) + 1] is None, r[len(key) + 1] or 0, r[len(key)]))
            if len(rows_of) < 2:
                continue
            found = compare([np.frombuffer(r[len(key) + 2], np.uint64) for r in rows_of], [r[-1] for r in rows_of] if sided else None)
            least: dict[int, dict] = {}
            a, b = [], []
            for i, r in enumerate(rows_of):
                own = {"rep": r[len(key) + 1], "cls": r[len(key)]}
                first = least.setdefault(found.root(i), own)
                if first is not own and first != own:
                    a.append(own)
                    b.append(first)
            yield pa.RecordBatch.from_arrays([pa.array(a, node), pa.array(b, node)], ["a", "b"])

    return dealt.select(*columns).mapInArrow(run, LINK)


def links(placed: DataFrame, own_sets: DataFrame) -> DataFrame:
    """``a, b``: enough links for the components of all tiles."""
    rows = placed.join(own_sets, "cls")
    small = compared(rows.where(F.col("m") <= TILE), ["hub", "band"])
    blocks = F.ceil(F.col("m") / TILE).cast("int")
    block = F.pmod(F.xxhash64("cls", F.lit(1)), blocks).cast("int")
    is_hub = F.col("cls") == F.col("hub")
    large = placed.where(F.col("m") > TILE).withColumns({"blocks": blocks, "block": block})
    # the hub is in every block
    first = large.withColumn("block", F.explode(F.when(is_hub, F.sequence(F.lit(0), F.col("blocks") - 1)).otherwise(F.array("block"))))
    met = stored(compared(first.join(own_sets, "cls"), ["hub", "band", "block"]), "jaccard-blocks")
    # classes that one step of the star joins to the hub are done
    stars = met.select(F.col("a.cls").alias("cls"), F.col("b.cls").alias("top")).distinct()
    hub_top = large.select("hub").distinct().join(stars, F.col("hub") == F.col("cls"), "left").select("hub", F.coalesce("top", "hub").alias("hub_top"))
    joined = hub_top.join(stars, F.col("hub_top") == F.col("top")).select("hub", F.col("cls"))
    joined = joined.union(hub_top.select("hub", F.col("hub_top").alias("cls"))).distinct()
    others = stored(large.join(joined, ["hub", "cls"], "left_anti").where(~is_hub), "jaccard-others")
    chunks = others.groupBy("hub", "band").agg(F.ceil(F.count("*") / TILE).cast("int").alias("chunks"))
    chunk = F.pmod(F.xxhash64("cls", F.lit(2)), F.col("chunks")).cast("int")
    left = (
        large.join(chunks, ["hub", "band"])
        .withColumn("chunk", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
        .select("hub", "band", "block", "chunk", "cls", "rep", F.lit(False).alias("right"))
    )
    right = (
        others.join(chunks, ["hub", "band"])
        .withColumn("chunk", chunk)
        .withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .select("hub", "band", "block", "chunk", "cls", "rep", F.lit(True).alias("right"))
    )
    crossed = compared(left.unionByName(right).join(own_sets, "cls"), ["hub", "band", "block", "chunk"], sided=True)
    return small.unionByName(met).unionByName(crossed).distinct()


def components(edges: DataFrame) -> DataFrame:
    """``node, top``: star contraction until nothing changes; nodes are ordered structs."""

    def mark(df: DataFrame) -> tuple:
        return df.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)"))).first()

    def ordered(df: DataFrame) -> DataFrame:
        low, high = F.least("a", "b"), F.greatest("a", "b")
        return df.select(high.alias("a"), low.alias("b")).where("a <> b").distinct()

    now = stored(ordered(edges), "jaccard-edges")
    before = mark(now)
    while before[0]:
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = stored(both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("top")), "jaccard-large")
        large = stored(ordered(both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("top").alias("b"))), "jaccard-large-star")
        least = stored(large.groupBy("a").agg(F.min("b").alias("top")), "jaccard-small")
        small = large.join(least, "a")
        now = stored(
            ordered(small.select("a", F.col("top").alias("b")).unionByName(small.select(F.col("b").alias("a"), F.col("top").alias("b")))),
            "jaccard-small-star",
        )
        after = mark(now)
        if after == before:
            break
        before = after
    return now.select(F.col("a").alias("node"), F.col("b").alias("top"))


def linked(docs: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """``doc_id, mark, n, cls`` of every row; the classes; and for each class but the
    least of its component, that one (``node``, ``top``)."""
    every = stored(sets(docs), "jaccard-sets")
    first = F.struct("doc_id", "mark")
    classes = stored(
        every.where("cls is not null")
        .groupBy("cls")
        .agg(
            F.min("doc_id").alias("rep"),
            # a row without id only where no row has one
            F.coalesce(F.min(F.when(F.col("doc_id").isNotNull(), first)), F.min(first)).alias("first"),
            F.max("n").alias("n"),
            F.max("low").alias("low"),
        ),
        "jaccard-classes",
    )
    placed = stored(tiles(classes), "jaccard-tiles")
    own_sets = stored(whole_sets(docs, placed.select("cls", "rep").distinct()), "jaccard-whole-sets")
    return every, classes, components(links(placed, own_sets))


def jaccard_components(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``n_shingles`` and ``component_id`` of every document."""
    every, classes, found = linked(docs)
    tops = found.select(F.col("node.cls").alias("cls"), F.col("top.rep").alias("top"))
    named = classes.select("cls", "rep").join(tops, "cls", "left").select("cls", F.coalesce("top", "rep").alias("component_id"))
    named = stored(named, "jaccard-components")
    joined = every.select("doc_id", "n", "cls").join(named, "cls", "left")
    return joined.select("doc_id", F.col("n").alias("n_shingles"), F.coalesce("component_id", "doc_id").alias("component_id"))


def keep_one(docs: DataFrame) -> DataFrame:
    """One row of each component: one with its smallest id.

    A row is known by its id and its text, so rows that repeat an id with
    another text are judged on their own. Documents without words all stay, and
    so do all rows without an id that repeat the kept text of their component.
    What goes is decided on ids and hashes; whole rows are read once, and only
    those that repeat an id and a text are ranked.
    """
    every, classes, found = linked(docs)
    least = classes.join(found.select(F.col("node.cls").alias("cls")), "cls", "left_anti")
    kept = least.select(F.col("first.doc_id").alias("id"), F.col("first.mark").alias("mark"))
    rows = every.where("cls is not null").select(F.col("doc_id").alias("id"), "mark")
    copies = rows.groupBy("id", "mark").agg(F.count("*").alias("copies"))
    own = F.struct(F.col("id").isNull(), F.coalesce("id", F.lit(0).cast(docs.schema["doc_id"].dataType)), "mark")
    state = copies.withColumn("key", own).join(
        kept.withColumn("key", own).select("key", F.lit(True).alias("stays")), "key", "left"
    )
    # most rows stay, once: only the others are named
    named = stored(state.where("stays is null or copies > 1").select("id", "mark", "stays"), "jaccard-decided")
    whole = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col("doc_id").alias("own"), mark(docs).alias("own_mark"))
    same = F.col("own").eqNullSafe(F.col("id")) & (F.col("own_mark") == F.col("mark"))
    once = whole.join(named, same, "left_anti").select("row")
    again = whole.join(named.where("stays"), same, "left_semi")
    ranked = again.withColumn("place", F.row_number().over(W.partitionBy("own", "own_mark").orderBy("own_mark")))
    return once.unionByName(ranked.where("place = 1 or own is null").select("row")).select("row.*")

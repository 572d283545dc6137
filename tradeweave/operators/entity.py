"""Entity resolution: which products have a counterpart in the other catalog.

Two products match when ``0.7 * JaroWinkler(lower names) + 0.3 * price
similarity`` reaches a threshold.

* **Pairs of names, not of products.** A similarity join on the distinct names
  of both sides scores each pair of names once, however many prices stand behind
  them.  It is an equi join on character prefixes whose length follows from the
  similarity that the closest prices of the two names leave to be reached.
* **Nearest prices.** Whether a name at one price has a partner under another
  name depends on the nearest prices of that name only; a sorted merge of asked
  and known prices of each name finds them.

``entity_match`` returns every product with at least one partner, a search for
existence.  Distinct (name, price) keys are first scored against a handful of
likely partners: the lowest and highest price under their own name, and the
nearest prices among names sharing the first word, first two words or first
letters.  Every hit is final and the cost is linear.  Only the names of keys
still open take part in the similarity join, which makes the answer exact.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tradeweave.functions import jaro_winkler, price_similarity
from tradeweave.functions.similarity import BOOST_ABOVE, BOOST_CHARS, BOOST_WEIGHT, jaro_winkler_once
from tradeweave.operators.similarity_join import overlap_pairs
from tradeweave.workspace import materialize

# Fixed values of the score.
THRESHOLD = 0.7
NAME_WEIGHT = 0.7
PRICE_WEIGHT = 0.3

# Expected rows per window group, and parts of a group's size that a task of
# the windows expects, so that groups that meet in one task stay few.
GROUP_ROWS = 200_000
GROUP_SPREAD = 4
# Narrowest price band of the pair join, as a difference of logarithms, and how
# often it may double before prices are not banded at all.
BAND_WIDTH = 0.01
BAND_LEVELS = 9
# Prices within 5 % share a group of the sorted merge.
MERGE_WIDTH = 0.05

_EPS = 1e-9


@dataclass(frozen=True)
class Rule:
    """When two products match, and on which columns.

    The defaults are the product rule.  Another text column with weights (1, 0)
    and no price compares texts only, image links for example.
    """

    threshold: float = THRESHOLD
    name_weight: float = NAME_WEIGHT
    price_weight: float = PRICE_WEIGHT
    name: str = "name"
    price: str | None = "discount_price"

    def score(self, names, prices):
        return self.name_weight * names + self.price_weight * prices

    def needed(self, prices: Column) -> Column:
        """The least name similarity of a match at a price similarity."""
        return (self.threshold - self.price_weight * prices) / self.name_weight

    def share_at(self, prices: Column, lead: Column) -> Column:
        """The shared-character bound (see overlap_pairs) at a price similarity and
        a number of equal leading characters, which are what boosts a similarity."""
        need, boost = self.needed(prices), BOOST_WEIGHT * lead
        boosted = F.greatest(F.lit(BOOST_ABOVE), (need - boost) / (1 - boost))
        return 3 * F.when(need <= BOOST_ABOVE, need).otherwise(boosted) - 1

    @property
    def share(self) -> float:
        """The shared-character bound of any match."""
        need = (self.threshold - self.price_weight) / self.name_weight
        if need <= 0:
            raise ValueError("a rule that equal prices alone satisfy does not compare names")
        boost = BOOST_WEIGHT * BOOST_CHARS
        return 3 * (need if need <= BOOST_ABOVE else max(BOOST_ABOVE, (need - boost) / (1 - boost))) - 1

    def key(self, df: DataFrame) -> dict[str, Column]:
        """What is compared: the lower-cased text and the price as a number."""
        price = F.lit(0.0) if self.price is None else df[self.price].cast("double")
        return {"name": F.lower(df[self.name]), "price": price}


def _keys(df: DataFrame, side: str, rule: Rule) -> DataFrame:
    key = [value.alias(name) for name, value in rule.key(df).items()]
    return df.select(F.lit(side).alias("side"), *key).dropna().distinct()


def _names(keys: DataFrame, side: str) -> DataFrame:
    """Distinct names with the ends of their prices."""
    return keys.groupBy(F.col("name").alias(f"name_{side}")).agg(
        F.min("price").alias(f"low_{side}"), F.max("price").alias(f"high_{side}")
    )


def _closest() -> Column:
    """An upper bound on the price similarity of two names' prices."""
    gap_above = F.when(F.col("high_a") < F.col("low_b"), price_similarity("high_a", "low_b"))
    gap_below = F.when(F.col("high_b") < F.col("low_a"), price_similarity("high_b", "low_a"))
    # Below 0 only for prices of two signs, where the ends of the gap are not the closest.
    return F.greatest(F.coalesce(gap_above, gap_below, F.lit(1.0)), F.lit(0.0))


def _lead() -> Column:
    """How many leading characters of two names are equal, as far as they count."""
    same = [
        (F.substring("name_a", 1, k) == F.substring("name_b", 1, k)) & (F.length("name_a") >= k) & (F.length("name_b") >= k)
        for k in range(1, BOOST_CHARS + 1)
    ]
    return reduce(Column.__add__, [s.cast("int") for s in same])


def name_pairs(keys_a: DataFrame, keys_b: DataFrame, rule: Rule) -> DataFrame:
    """(name_a, name_b, name_similarity) of all names that can match at some price.

    The frames have ``name`` and ``price``; each pair of names is scored once.
    """
    pairs = overlap_pairs(
        _names(keys_a, "a"), _names(keys_b, "b"), "name_a", "name_b", rule.share, rule.share_at(_closest(), _lead())
    )
    scored = pairs.withColumn("name_similarity", jaro_winkler_once("name_a", "name_b"))
    able = rule.score(F.col("name_similarity"), _closest()) >= rule.threshold - _EPS
    return scored.where(able).select("name_a", "name_b", "name_similarity")


def _banded(level: str, price: str) -> Column:
    """Bands of ``BAND_WIDTH * 2 ** level``; the last level has a single one."""
    width = F.lit(BAND_WIDTH) * F.pow(F.lit(2.0), F.col(level))
    # Two non-positive prices count as equal, so they share one band.
    band = F.when(F.col(price) > 0, F.floor(F.log(price) / width)).otherwise(-(1 << 40))
    return F.when(F.col(level) > BAND_LEVELS, 0).otherwise(band)


def entity_match_pairs(a: DataFrame, b: DataFrame, rule: Rule) -> DataFrame:
    """All pairs of distinct (lower-cased name, price) that match.

    ``rows_a`` and ``rows_b`` count the products behind each key, so copies add
    no pairs.  The result grows with the number of pairs: meant for strict rules.

    What a pair of names leaves to the prices sets how wide the price bands are
    in which its prices meet.
    """

    def counted(df: DataFrame) -> DataFrame:
        key = [value.alias(name) for name, value in rule.key(df).items()]
        return df.select(*key).dropna().groupBy("name", "price").agg(F.count(F.lit(1)).alias("rows"))

    def sided(keys: DataFrame, side: str) -> DataFrame:
        return keys.withColumnsRenamed({c: f"{c}_{side}" for c in keys.columns})

    keys_a = materialize(counted(a), "entity-keys-a")
    keys_b = materialize(counted(b), "entity-keys-b")
    if rule.price_weight:
        need = (rule.threshold - rule.name_weight * F.col("name_similarity")) / rule.price_weight - _EPS
        doublings = F.ceil(F.log2(-F.log(need) / BAND_WIDTH + _EPS)).cast("int")
        level = F.when(need >= 1, 0).when(
            need > math.exp(-BAND_WIDTH * 2**BAND_LEVELS), F.greatest(doublings, F.lit(0))
        )
        level = F.coalesce(level, F.lit(BAND_LEVELS + 1))
    else:
        level = F.lit(BAND_LEVELS + 1)
    names = materialize(name_pairs(keys_a, keys_b, rule).withColumn("level", level), "entity-names")
    left = (
        sided(keys_a, "a")
        .join(names, "name_a")
        .withColumn("band", _banded("level", "price_a"))
        .withColumn(
            "band",
            F.explode(
                F.when(F.col("level") > BAND_LEVELS, F.array("band")).otherwise(
                    F.array(F.col("band") - 1, F.col("band"), F.col("band") + 1)
                )
            ),
        )
    )
    right = (
        sided(keys_b, "b")
        .join(names.select("name_b", "level").distinct(), "name_b")
        .withColumn("band", _banded("level", "price_b"))
    )
    close = price_similarity("price_a", "price_b")
    return (
        left.join(right, ["name_b", "level", "band"])
        .withColumn("price_similarity", close)
        .withColumn("score", rule.score(F.col("name_similarity"), F.col("price_similarity")))
        .where(F.col("score") >= rule.threshold)
        .select(
            "name_a", "price_a", "rows_a", "name_b", "price_b", "rows_b",
            "name_similarity", "price_similarity", "score",
        )
    )


def _same_name_hits(keys: DataFrame, rule: Rule) -> DataFrame:
    """Keys whose own name occurs on the other side at a close enough price."""
    extremes = keys.groupBy(
        F.when(F.col("side") == "a", "b").otherwise("a").alias("side"), "name"
    ).agg(F.min("price").alias("low"), F.max("price").alias("high"))
    close = F.greatest(price_similarity("price", "low"), price_similarity("price", "high"))
    return keys.join(extremes, ["side", "name"]).select(
        "side", "name", "price", (rule.score(F.lit(1.0), close) >= rule.threshold).alias("hit")
    )


def _cut(df: DataFrame, group: Sequence[str], place: Column, name: str) -> DataFrame:
    """Adds ``name``, a number that cuts each group of more than ``GROUP_ROWS`` rows
    by ``place`` (from 0 up to 1).  Other groups stay whole, whatever the input."""
    n = F.count(F.lit(1))
    big = df.groupBy(*group).agg(F.ceil(n / GROUP_ROWS).alias("__cuts")).where("__cuts > 1")
    # At most one row per GROUP_ROWS rows; written so that its real size is known.
    big = materialize(big, "entity-cuts")
    cut = F.floor(place * F.coalesce("__cuts", F.lit(1))).cast("int")
    return df.join(big, list(group), "left").withColumn(name, cut).drop("__cuts")


def _near_price_hits(keys: DataFrame, rule: Rule) -> DataFrame:
    """Keys scored against the nearest prices of the other side in their blocks.

    A block is a name feature within a 5 % price band.  A block too big for one
    task is cut into price ranges, and by name what is still too big: partners
    across a cut are missed, which only leaves more keys to the exact step.
    """
    words = F.split("name", " ")
    features = {
        "name": F.col("name"),
        "first": F.element_at(words, 1),
        "start": F.array_join(F.slice(words, F.lit(1), F.lit(2)), " "),
        "lead": F.substring("name", 1, 3),
    }
    blocks = F.array(*[F.struct(F.lit(tag).alias("tag"), value.alias("block")) for tag, value in features.items()])
    scale = F.log("price") * 20
    band = F.when(F.col("price") > 0, F.floor(scale)).otherwise(-(1 << 40))
    in_band = F.when(F.col("price") > 0, scale - F.floor(scale)).otherwise(0.0)
    by_name = F.pmod(F.xxhash64("name"), F.lit(1 << 20)) / (1 << 20)
    parts = ["tag", "block", "band", "range"]
    blocked = keys.select("side", "name", "price", F.inline(blocks)).withColumn("band", band)
    blocked = _cut(_cut(blocked, parts[:3], in_band, "range"), parts, by_name, "lane")
    # Named here, as a join on the blocks alone would do for the window too.
    # What a task sorts is bounded by more tasks for more rows.
    tasks = math.ceil(GROUP_SPREAD * len(features) * keys.count() / GROUP_ROWS)
    few = tasks <= int(keys.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    blocked = blocked.repartition(*([] if few else [tasks]), *parts, "lane")
    group = Window.partitionBy(*parts, "lane").rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    # Opposite directions, both reading backwards: a running value is cheap,
    # a look-ahead frame is evaluated anew for every row.
    upward = group.orderBy(F.asc("price"), F.asc("side"))
    downward = group.orderBy(F.desc("price"), F.desc("side"))

    def nearest(way) -> Column:
        seen = {
            side: F.last(
                F.when(F.col("side") == side, F.struct("name", "price")), ignorenulls=True
            ).over(way)
            for side in "ab"
        }
        return F.when(F.col("side") == "a", seen["b"]).otherwise(seen["a"])

    tried = blocked.withColumns({"below": nearest(upward), "above": nearest(downward)})

    def hit(other: str) -> Column:
        reached = rule.score(
            jaro_winkler(F.col("name"), F.col(f"{other}.name")),
            price_similarity("price", f"{other}.price"),
        )
        return F.coalesce(reached >= rule.threshold, F.lit(False))

    return tried.select("side", "name", "price", (hit("below") | hit("above")).alias("hit"))


def nearest_prices(asked: DataFrame, known: DataFrame, name: str) -> DataFrame:
    """``asked`` with ``below``, ``above`` and ``top``: of the ``known`` prices under
    the same name, the nearest ones on either side and the highest.

    Both frames have ``name`` and ``price``.  The sorted merge runs in price
    ranges of ``MERGE_WIDTH``; what lies beyond a range comes from the ends of the
    ranges next to it, so that a frequent name is spread over many tasks.
    """
    carried = [c for c in asked.columns if c not in (name, "price")]
    place = F.when(F.col("price") > 0, F.floor(F.log("price") / MERGE_WIDTH)).otherwise(-(1 << 40))
    no_row = F.lit(None).cast(asked.select(F.struct("price", *carried)).schema[0].dataType)
    rows = (
        asked.select(name, "price", F.lit(None).cast("double").alias("known"), F.struct("price", *carried).alias("row"))
        .unionByName(known.select(name, "price", F.col("price").alias("known"), no_row.alias("row")))
        .withColumn("range", place)
    )
    ends = rows.groupBy(name, "range").agg(F.min("known").alias("least"), F.max("known").alias("most"))
    ordered = Window.partitionBy(name).orderBy("range")
    before = ordered.rowsBetween(Window.unboundedPreceding, -1)
    after = Window.partitionBy(name).orderBy(F.desc("range")).rowsBetween(Window.unboundedPreceding, -1)
    ends = ends.select(
        name,
        "range",
        F.max("most").over(before).alias("lower"),
        F.min("least").over(after).alias("higher"),
        F.max("most").over(Window.partitionBy(name)).alias("top"),
    )
    here = Window.partitionBy(name, "range").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    # A known price comes before what asks for it, either way.
    first = F.col("known").isNull()
    own = {
        "own_below": F.last("known", ignorenulls=True).over(here.orderBy("price", first)),
        "own_above": F.last("known", ignorenulls=True).over(here.orderBy(F.desc("price"), first)),
    }
    merged = rows.withColumns(own).where("row is not null")
    return merged.join(ends, [name, "range"]).select(
        name,
        "row.*",
        F.coalesce("own_below", "lower").alias("below"),
        F.coalesce("own_above", "higher").alias("above"),
        "top",
    )


def _exact_hits(open_keys: DataFrame, other_keys: DataFrame, rule: Rule) -> DataFrame:
    """The open keys that have a partner anywhere among ``other_keys``."""
    pairs = materialize(name_pairs(open_keys, other_keys, rule), "entity-names")
    mine = open_keys.select(F.col("name").alias("name_a"), "price")
    if not rule.price_weight:
        return mine.join(pairs, "name_a", "left_semi").select(F.col("name_a").alias("name"), "price")
    asked = mine.join(pairs, "name_a")
    known = other_keys.select(F.col("name").alias("name_b"), "price")
    tried = nearest_prices(asked, known, "name_b")
    # Two prices of different signs are the closer the higher the positive one is.
    close = F.greatest(*[price_similarity("price", c) for c in ("below", "above", "top")])
    hits = tried.where(rule.score(F.col("name_similarity"), close) >= rule.threshold)
    return hits.select(F.col("name_a").alias("name"), "price").distinct()


def matched_keys(a: DataFrame, b: DataFrame, rule: Rule = Rule()) -> DataFrame:
    """(side, name, price) of every distinct key with a partner on the other side."""
    keys = materialize(_keys(a, "a", rule).unionByName(_keys(b, "b", rule)), "entity-keys")
    tried = _same_name_hits(keys, rule).unionByName(_near_price_hits(keys, rule))
    tried = materialize(
        tried.groupBy("side", "name", "price").agg(F.max("hit").alias("hit")), "entity-tried"
    )
    open_keys = tried.where(~F.col("hit")).drop("hit")
    found = [tried.where("hit").drop("hit")]
    sides = {r["side"] for r in open_keys.select("side").distinct().collect()}
    for side, other in (("a", "b"), ("b", "a")):
        if side in sides:
            hits = _exact_hits(
                open_keys.where(F.col("side") == side), keys.where(F.col("side") == other), rule
            )
            found.append(hits.select(F.lit(side).alias("side"), "name", "price"))
    return reduce(DataFrame.unionByName, found)


def entity_match(a: DataFrame, b: DataFrame, rule: Rule = Rule()) -> DataFrame:
    """Distinct products of both catalogs that have a partner in the other one.

    Both frames have the same columns, those the rule names among them; the
    default rule suits the mediated contract (see ``sinks.contract``).
    """
    keys = matched_keys(a, b, rule)

    def members(df: DataFrame, side: str) -> DataFrame:
        mine = keys.where(F.col("side") == side)
        rows = df.distinct()
        same = [value == mine[name] for name, value in rule.key(rows).items()]
        return rows.join(mine, same, "left_semi")

    return members(a, "a").unionByName(members(b, "b"))

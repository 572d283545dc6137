"""Filter interaction audit: what each filter removes in every order of application.

1. One pass gives each document a bit mask of the filters it fails. Whether a
   text repeats one of a smaller id is a fact about all documents: equal texts
   are folded to one row a part first, so copies meet no single task, and the
   bit is set by counting, without a join back to the documents.
2. Documents with the same part and mask are alike to every order, so they
   become one weighted cell: at most 32 cells a part, whatever the input.
3. Each cell folds across the array of all 120 orders, a constant that Spark
   ships with the plan: ``transform`` over the orders, ``aggregate`` over the
   steps of one. That makes 600 weighted structs a cell.
4. The structs of a part's cells are summed element by element.

Defined results: a null text is empty; a null ``lang`` is the part ``''``; a row
without id never counts as a repeat and makes none; rows that repeat an id and a
text are each counted, and none makes the other a repeat; a document with
several label rows is good (toxic) if one of them says so; labels without a
document count nowhere; an empty table gives no rows.
"""

from __future__ import annotations

from functools import reduce
from itertools import permutations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

# Fixed values of the contract.
FILTERS = "ABCDE"
SPACE = r"[\x20\x09-\x0D]+"
SYMBOLS = r"[#$%&*|]"
COUNTS = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost")
#: Bit of the filter that asks for other documents.
REPEAT = 1 << FILTERS.index("E")


def own_failures(text: Column) -> dict[str, Column]:
    """Filters that one text decides."""
    words = F.array_remove(F.split(text, SPACE), "")
    capitals = F.length(text) - F.length(F.regexp_replace(text, "[A-Z]", ""))
    return {
        "A": F.size(words) < 100,
        "B": 100 * F.size(F.array_distinct(words)) < 80 * F.size(words),
        "C": 100 * capitals > 10 * F.length(text),
        "D": text.rlike(SYMBOLS),
    }


def _flags(labels: DataFrame) -> DataFrame:
    said = [F.max((F.col(f"`{c}`") == 1).cast("long")).alias(f"is_{name}") for c, name in (("quality", "good"), ("toxic", "toxic"))]
    return labels.where("doc_id is not null").groupBy(F.col("doc_id").alias("label_id")).agg(*said)


def mask_cells(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``part, mask, n, good, toxic``: documents of each part that fail the same filters."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    bits = [F.when(failed, 1 << FILTERS.index(f)).otherwise(0) for f, failed in own_failures(text).items()]
    rows = docs.select(
        F.col("doc_id").alias("id"),
        F.coalesce(F.col("lang").cast("string"), F.lit("")).alias("part"),
        F.unhex(F.sha2(text, 256)).alias("digest"),
        reduce(Column.__add__, bits).alias("mask"),
    )
    # rows without an id match no label; the digest keeps them out of one task
    rows = rows.withColumn("lane", F.when(F.col("id").isNull(), F.xxhash64("digest").bitwiseOR(F.lit(1))).otherwise(F.lit(0).cast("long")))
    named = rows.withColumn("any_id", F.coalesce("id", F.lit(0).cast(docs.schema["doc_id"].dataType)))
    flagged = named.join(
        _flags(labels).withColumn("label_lane", F.lit(0).cast("long")),
        (F.col("any_id") == F.col("label_id")) & (F.col("lane") == F.col("label_lane")),
        "left",
    )
    sums = [F.sum(c).alias(o) for c, o in (("n", "n"), ("good", "good"), ("toxic", "toxic"))]
    folded = flagged.groupBy("digest", "part", "mask", "id").agg(
        F.count("*").alias("n"),
        F.sum(F.coalesce("is_good", F.lit(0).cast("long"))).alias("good"),
        F.sum(F.coalesce("is_toxic", F.lit(0).cast("long"))).alias("toxic"),
    )
    counts = F.struct("n", "good", "toxic")
    texts = folded.groupBy("digest", "part", "mask").agg(
        *sums,
        # those at the smallest id, and those without one, repeat nothing
        F.min(F.when(F.col("id").isNotNull(), F.struct("id", counts.alias("counts")))).alias("first"),
        *[F.sum(F.when(F.col("id").isNull(), F.col(c)).otherwise(0)).alias(f"free_{c}") for c in ("n", "good", "toxic")],
    )
    # one row for each part that holds the text
    least = F.min("first.id").over(W.partitionBy("digest"))
    new = [
        (F.col(f"free_{c}") + F.when(F.col("first.id") == F.col("least"), F.col(f"first.counts.{c}")).otherwise(0)).alias(c)
        for c in ("n", "good", "toxic")
    ]
    split = texts.withColumn("least", least).withColumn("new", F.struct(*new))
    again = F.struct(*[(F.col(c) - F.col(f"new.{c}")).alias(c) for c in ("n", "good", "toxic")])
    two = F.array(
        F.struct(F.col("mask"), F.col("new").alias("counts")),
        F.struct((F.col("mask") + REPEAT).alias("mask"), again.alias("counts")),
    )
    cells = split.select("part", F.inline(two)).select("part", "mask", "counts.*").where("n > 0")
    return cells.groupBy("part", "mask").agg(*sums)


def _steps(order: Column) -> Column:
    """The weighted structs of one cell for one order, a fold over its filters."""

    def bit(letter: Column) -> Column:
        return F.call_function("shiftleft", F.lit(1), F.call_function("instr", F.lit(FILTERS), letter) - 1)

    def weight(hit: Column, column: str) -> Column:
        return F.when(hit, F.col(column)).otherwise(F.lit(0).cast("long"))

    def add(state: Column, step: Column) -> Column:
        own = bit(F.substring(order, step, F.lit(1)))
        fails, gone = F.col("mask").bitwiseAND(own) != 0, state["gone"]
        out = F.struct(
            order.alias("filter_order"),
            step.alias("step"),
            weight(~gone & ~fails, "n").alias("kept"),
            weight(~gone & fails, "n").alias("removed"),
            weight(gone & fails, "n").alias("redundant"),
            weight(F.col("mask") == own, "n").alias("unique_fails"),
            weight(~gone & fails, "good").alias("good_lost"),
            weight(~gone & fails, "toxic").alias("toxic_lost"),
        )
        return F.struct((gone | fails).alias("gone"), F.concat(state["out"], F.array(out)).alias("out"))

    fields = "array<struct<filter_order:string,step:int," + ",".join(f"{c}:bigint" for c in COUNTS) + ">>"
    start = F.struct(F.lit(False).alias("gone"), F.from_json(F.lit("[]"), fields).alias("out"))
    return F.aggregate(F.sequence(F.lit(1), F.lit(len(FILTERS))), start, add, lambda state: state["out"])


def interactions(cells: DataFrame) -> DataFrame:
    """``part, filter_order, step``, ``COUNTS`` and ``shapley`` from weighted mask cells."""
    orders = F.lit(["".join(p) for p in permutations(FILTERS)])
    folded = cells.select("part", F.inline(F.flatten(F.transform(orders, _steps))))
    merged = folded.groupBy("part", "filter_order", "step").agg(*[F.sum(c).alias(c) for c in COUNTS])
    own = W.partitionBy("part", F.substring("filter_order", F.col("step"), F.lit(1)))
    return merged.withColumn("shapley", F.sum("removed").over(own))


def filter_audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The audit of the five filters over ``documents``."""
    return interactions(mask_cells(docs, labels))

"""Ranking names by the larger of TF-IDF cosine and Jaro-Winkler."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradeweave.functions import jaro_winkler
from tradeweave.workspace import materialize

# Fixed value: a token is two or more word characters.
TOKEN = r"(?U)\b\w\w+\b"
# A token in at least 1/FREQUENT of all postings is frequent.  There are at most
# FREQUENT such tokens, which is what makes broadcasting them safe.
FREQUENT = 1000
LANES = 1024


def _tokens(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(text), F.lit(TOKEN), F.lit(0))


def tfidf_rank(candidates: DataFrame, column: str, query: str) -> DataFrame:
    """(name, cosine, jaro_winkler, score) for every distinct candidate name.

    TF-IDF is fitted on the query and all candidates, with smoothed idf and
    length-normalised vectors.
    """
    spark = candidates.sparkSession
    names = materialize(
        candidates.select(F.col(column).alias("name")).dropna().distinct(), "rank-names"
    )
    asked = (
        spark.range(1)
        .select(F.explode(_tokens(F.lit(query))).alias("token"))
        .groupBy("token")
        .agg(F.count(F.lit(1)).alias("tf"))
    )
    asked_tokens = {r["token"]: r["tf"] for r in asked.collect()}

    postings = (
        names.select("name", F.explode(_tokens(F.col("name"))).alias("token"))
        .groupBy("name", "token")
        .agg(F.count(F.lit(1)).alias("tf"))
    )
    n_docs = names.count() + 1
    in_query = F.col("token").isin(*asked_tokens) if asked_tokens else F.lit(False)
    found = materialize(
        postings.groupBy("token").agg(F.count(F.lit(1)).alias("n")), "rank-tokens"
    )
    idf = found.select(
        "token",
        "n",
        (F.log((1.0 + n_docs) / (1 + F.col("n") + in_query.cast("int"))) + 1).alias("idf"),
    )

    # A token such as a brand word sits in most names.  Those few are joined by
    # broadcast, and their postings are spread evenly over the shuffle that
    # joins the rest.
    n_postings = found.agg(F.sum("n")).first()[0] or 0
    frequent = idf.where(F.col("n") * FREQUENT >= n_postings).select(
        "token", F.col("idf").alias("idf_frequent")
    )
    rest = idf.where(F.col("n") * FREQUENT < n_postings).select(
        F.col("token").alias("key"), F.col("idf").alias("idf_rest")
    )
    lane = F.concat(F.lit("\u0000"), F.pmod(F.xxhash64("name"), F.lit(LANES)).cast("string"))
    weighted = (
        postings.join(F.broadcast(frequent), "token", "left")
        .withColumn("key", F.when(F.col("idf_frequent").isNull(), F.col("token")).otherwise(lane))
        .join(rest, "key", "left")
        .select("name", "token", "tf", F.coalesce("idf_frequent", "idf_rest").alias("idf"))
    )

    # The query's own vector: a token no candidate has only adds to its length.
    asked_tf = (
        F.coalesce(
            F.create_map(*[F.lit(x) for kv in asked_tokens.items() for x in kv])[F.col("token")],
            F.lit(0),
        )
        if asked_tokens
        else F.lit(0)
    )
    asked_idf = (
        asked.join(idf.where(in_query).select("token", "idf"), "token", "left")
        .select((F.col("tf") * F.coalesce("idf", F.log(F.lit((1 + n_docs) / 2)) + 1)).alias("w"))
        .agg(F.sqrt(F.sum(F.col("w") * F.col("w"))))
    )
    weight = F.col("tf") * F.col("idf")
    cosines = weighted.groupBy("name").agg(
        (
            F.sum(weight * asked_tf * F.col("idf")) / F.sqrt(F.sum(weight * weight))
        ).alias("dot")
    )
    return (
        names.join(cosines, "name", "left")
        .withColumn("cosine", F.coalesce(F.col("dot") / asked_idf.scalar(), F.lit(0.0)))
        .withColumn("jaro_winkler", jaro_winkler(F.lit(query), F.col("name")))
        .select(
            "name", "cosine", "jaro_winkler", F.greatest("cosine", "jaro_winkler").alias("score")
        )
    )

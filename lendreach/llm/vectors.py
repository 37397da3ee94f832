"""What the vector searches share: usable vectors, copies collapsed before the search and restored after it."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def finite(df: DataFrame, key: str, vector: str, *more: Column) -> DataFrame:
    """(id, vec double, more) of the rows whose vector is neither null nor empty and holds nothing null or non-finite."""
    return df.select(F.col(key).cast("long").alias("id"), F.col(vector).cast("array<double>").alias("vec"), *more).filter(
        "vec is not null and size(vec) > 0 and "
        "forall(vec, x -> x is not null and not isnan(x) and abs(x) < double('Infinity'))")


def usable(df: DataFrame, key: str, vector: str) -> DataFrame:
    """(id, vec double) of the rows that take part: an id, a vector of the commonest length (ties: the longer),
    and nothing null or non-finite in it."""
    rows = df.select(F.col(key).cast("long").alias("id"), F.col(vector).cast("array<double>").alias("vec")).filter(
        "id is not null and vec is not null and size(vec) > 0 and "
        "forall(vec, x -> x is not null and not isnan(x) and abs(x) < double('Infinity'))")
    first = rows.groupBy(F.size("vec").alias("n")).count().orderBy(F.desc("count"), F.desc("n")).first()
    return rows.filter(F.size("vec") == (first["n"] if first else 0))


def distinct_vectors(rows: DataFrame, k: int) -> DataFrame:
    """(rep, ids, vec): one row a different vector with its ``k + 1`` least ids, of which rep is the least.

    No answer of ``k`` neighbours can hold a copy beyond those: each of them goes before it in every tie.
    A repeated id counts once.
    """
    order = W.partitionBy("vec").orderBy("id")
    return (rows.withColumn("__r", F.dense_rank().over(order)).filter(F.col("__r") <= k + 1)
            .groupBy("vec").agg(F.sort_array(F.collect_set("id")).alias("ids"))
            .select(F.col("ids")[0].alias("rep"), "ids", "vec"))


def query_vectors(rows: DataFrame, chosen: Column) -> tuple[DataFrame, DataFrame]:
    """(qrep, vec) of the different query vectors, and (query_id, qrep) of every query."""
    asked = rows.filter(chosen).dropDuplicates(["id"])
    once = asked.groupBy("vec").agg(F.min("id").alias("qrep")).select("qrep", "vec")
    return once, asked.join(once, "vec").select(F.col("id").alias("query_id"), "qrep")


def answers(found: DataFrame, groups: DataFrame, members: DataFrame, k: int) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` best of every query but itself, ties to the lesser id.

    ``found`` (qrep, rep, score) must hold the ``k + 1`` best different vectors of each query vector.
    """
    best = W.partitionBy("qrep").orderBy(F.desc("score"), "rep")
    top = found.withColumn("__r", F.row_number().over(best)).filter(F.col("__r") <= k + 1).drop("__r")
    ids = top.join(groups.select("rep", "ids"), "rep").select("qrep", "score", F.explode("ids").alias("vec_id"))
    lists = ids.groupBy("qrep").agg(F.slice(F.sort_array(F.collect_list(
        F.struct((-F.col("score")).alias("minus"), "vec_id", "score"))), 1, k + 1).alias("best"))
    mine = F.slice(F.filter("best", lambda x: x["vec_id"] != F.col("query_id")), 1, k)
    return (members.join(lists, "qrep").select("query_id", F.posexplode(mine).alias("rank", "b"))
            .select("query_id", (F.col("rank") + 1).alias("rank"), F.col("b.vec_id").alias("vec_id"),
                    F.col("b.score").alias("score")))


def in_turns(points: DataFrame, asked: DataFrame, by: list[str], most: int) -> tuple[DataFrame, DataFrame]:
    """Both sides with a column ``turn``: the queries (by ``qrep``) of a group ``by`` are dealt to turns of about
    ``most``, and the points of the group stand in each of them; points that nobody asks for go."""
    turns = asked.groupBy(*by).agg(F.ceil(F.count("*") / most).cast("int").alias("turns"))
    return (points.join(turns, by).withColumn("turn", F.explode(F.sequence(F.lit(0), F.col("turns") - 1))).drop("turns"),
            asked.join(turns, by).withColumn("turn", F.pmod(F.xxhash64("qrep"), F.col("turns")).cast("int")).drop("turns"))


def matrix(column) -> np.ndarray:
    """Rows x components of an Arrow list column of one length, as doubles."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    n = len(column)
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(n, -1) if n else np.zeros((0, 0))

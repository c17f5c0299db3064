"""Bounded samples of labelled or plain documents for model fitting."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def fold(doc_id: Column, parts: int) -> Column:
    """crc32 of the id as text, modulo ``parts`` (a null id counts as empty text)."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % parts


def in_hash_order(ids: DataFrame, n: int, seed: int, salt: str) -> DataFrame:
    """The ``n`` rows whose ids come first in a seeded hash order: a random
    sample that reruns and any partitioning agree on."""
    return ids.orderBy(F.xxhash64(F.lit(seed), F.lit(salt), F.col("doc_id")), "doc_id").limit(n)


def keyed(rows: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, text, t, n): the whole text of every row, its hash and its length."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    return rows.select(F.col(id_col).cast("long").alias("id"), text.alias("text"), F.xxhash64(text).alias("t"),
                       F.length(text).cast("long").alias("n"))


def rows_in_hash_order(rows: DataFrame, limit: int, seed: int, salt: str) -> list:
    """At most ``limit`` of the distinct (id, t, n) of ``keyed`` rows, in a
    seeded hash order of the ids (rows without an id: of the texts)."""
    order = F.xxhash64(F.lit(seed), F.lit(salt), F.coalesce("id", "t"))
    return rows.select("id", "t", "n").distinct().orderBy(order, "id", "t").limit(limit).collect()


def one_row_each(rows: DataFrame, ids: DataFrame, marks: list[str]) -> list:
    """One (id, t, n, marks) of ``keyed`` rows for each row of ``ids`` (id,
    marks; bounded by the caller) that they hold: of several texts under one
    id the one with the smallest hash."""
    wanted = ids.select(F.col("id").alias("_w"), *marks)
    return (rows.select("id", "t", "n").join(F.broadcast(wanted), F.col("id") == F.col("_w"))
            .groupBy("id", *marks).agg(F.min(F.struct("t", "n")).alias("r")).select("id", "r.t", "r.n", *marks).collect())


def texts_of(rows: DataFrame, picked: list[tuple], marks: str) -> DataFrame:
    """(id, t, text, marks): one row for each of ``picked``, a bounded list of
    (id, t, marks), however often ``keyed`` rows repeat it."""
    p = rows.sparkSession.createDataFrame(picked, f"_w long, _t long, {marks}")
    names = p.columns[2:]
    return (rows.select("id", "t", "text").join(F.broadcast(p), F.col("id").eqNullSafe(F.col("_w")) & (F.col("t") == F.col("_t")))
            .groupBy("id", "t", *names).agg(F.first("text").alias("text")))

"""Seeded point sets keyed by table rows (SRC-11).

Every point hangs off a row key of a given table, so the set grows with
the table.  Randomness comes from the MD5 of ``seed:key:stream``: the same
key and seed give the same point whatever the partitioning, retries or
executor losses (``rand(seed)`` depends on the partition layout), and in any
engine (``uniform_sql``, ``normal_sql``).
Normal draws use the Box-Muller transform of two such uniforms.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_TWO52 = float(2 ** 52)


def uniform(key: Column, seed: int, stream: int | Column) -> Column:
    """U[0, 1) from the first 52 bits of the digest of (seed, key, stream)."""
    digest = F.md5(F.concat_ws(":", F.lit(str(seed)), key.cast("string"), F.lit(stream).cast("string")))
    return F.conv(F.substring(digest, 1, 13), 16, 10).cast("double") / F.lit(_TWO52)


def uniform_sql(key: str, seed: int, stream: str) -> str:
    """The same in DuckDB."""
    return f"(CAST('0x' || substr(md5('{seed}:' || CAST({key} AS VARCHAR) || ':' || CAST({stream} AS VARCHAR)), 1, 13) AS BIGINT) / {_TWO52!r}::DOUBLE)"


def normal_sql(key: str, seed: int, stream: str) -> str:
    u1, u2 = (uniform_sql(key, seed, f"(2 * ({stream}) + {i})") for i in (0, 1))
    return f"(sqrt(-2.0 * ln(1.0 - {u1})) * cos({2 * math.pi!r}::DOUBLE * {u2}))"


def normal(key: Column, seed: int, stream: int) -> Column:
    u1 = F.lit(1.0) - uniform(key, seed, 2 * stream)       # (0, 1]
    u2 = uniform(key, seed, 2 * stream + 1)
    return F.sqrt(F.lit(-2.0) * F.log(u1)) * F.cos(F.lit(2 * math.pi) * u2)


def blobs(df: DataFrame, key: str, centres: int, dims: int = 2, std: float = 1.0,
          box: tuple[float, float] = (-10.0, 10.0), seed: int = 0) -> DataFrame:
    """Gaussian blobs: each row picks a centre uniformly; centres are drawn
    in ``box`` from the seed alone.  Returns (id, x array, label)."""
    k = F.col(key)
    lab = F.least(F.floor(uniform(k, seed, 1) * centres), F.lit(centres - 1)).cast("int")
    lo, hi = box
    centre = F.transform(F.sequence(F.lit(0), F.lit(dims - 1)),
                         lambda j: F.lit(lo) + F.lit(hi - lo) *
                         uniform(F.lit(-1).cast("long") * (lab.cast("long") + 1), seed, 1000 + j))
    x = F.transform(F.sequence(F.lit(0), F.lit(dims - 1)),
                    lambda j: centre[j] + F.lit(std) * normal(k, seed, 10 + j))
    return df.select(k.alias("id"), x.alias("x"), lab.alias("label"))


def circles(df: DataFrame, key: str, factor: float = 0.5, noise: float = 0.05, seed: int = 0) -> DataFrame:
    """Two concentric circles: label 0 on radius 1, label 1 on ``factor``."""
    k = F.col(key)
    lab = (uniform(k, seed, 1) >= 0.5).cast("int")
    t = F.lit(2 * math.pi) * uniform(k, seed, 2)
    rad = F.when(lab == 0, F.lit(1.0)).otherwise(F.lit(factor))
    x = F.array(rad * F.cos(t) + F.lit(noise) * normal(k, seed, 3),
                rad * F.sin(t) + F.lit(noise) * normal(k, seed, 4))
    return df.select(k.alias("id"), x.alias("x"), lab.alias("label"))


def moons(df: DataFrame, key: str, noise: float = 0.05, seed: int = 0) -> DataFrame:
    """Two interleaving half circles: label 0 is (cos t, sin t), label 1 is
    (1 - cos t, 0.5 - sin t), t in [0, pi]."""
    k = F.col(key)
    lab = (uniform(k, seed, 1) >= 0.5).cast("int")
    t = F.lit(math.pi) * uniform(k, seed, 2)
    cx = F.when(lab == 0, F.cos(t)).otherwise(F.lit(1.0) - F.cos(t))
    cy = F.when(lab == 0, F.sin(t)).otherwise(F.lit(0.5) - F.sin(t))
    x = F.array(cx + F.lit(noise) * normal(k, seed, 3), cy + F.lit(noise) * normal(k, seed, 4))
    return df.select(k.alias("id"), x.alias("x"), lab.alias("label"))


def separable(df: DataFrame, key: str, dims: int = 2, shift: float = 4.0, seed: int = 0) -> DataFrame:
    """Two classes, unit normal around 0 and around ``shift`` in every
    dimension."""
    k = F.col(key)
    lab = (uniform(k, seed, 1) >= 0.5).cast("int")
    x = F.transform(F.sequence(F.lit(0), F.lit(dims - 1)),
                    lambda j: normal(k, seed, 10 + j) + lab.cast("double") * F.lit(shift))
    return df.select(k.alias("id"), x.alias("x"), lab.alias("label"))


def with_outlier(points: DataFrame, x: list[float], key: int = -1, label: int = -1) -> DataFrame:
    """Append one labelled point (the reference adds a single outlier)."""
    spark = points.sparkSession
    row = spark.createDataFrame([(key, [float(v) for v in x], label)], "id long, x array<double>, label int")
    return points.select(F.col("id").cast("long"), F.col("x").cast("array<double>"),
                         F.col("label").cast("int")).unionByName(row)

"""File sources and sinks: CSV, text, JSON (SRC-1..6, SRC-9, SNK-1, SNK-2).

Readers take an explicit schema (inference is a second pass over the data
and is offered for exploration only).  Written files go under the folder
the session names in ``spark.checkpoint.dir`` (shared storage on a
cluster), one fresh sub-folder per call, never a machine-local folder.
"""

from __future__ import annotations


from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from orrery import session


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new, unique folder below the shared checkpoint folder."""
    return session.scratch_path(spark, name)


# ------------------------------------------------------------------ CSV --

def write_csv(df: DataFrame, path: str, header: bool = True, null_value: str | None = None,
              compression: str | None = None, mode: str = "overwrite") -> str:
    """SNK-1: delimited output; ``mode="append"`` adds files to the folder."""
    w = df.write.mode(mode).option("header", header)
    if null_value is not None:
        w = w.option("nullValue", null_value)
    if compression:
        w = w.option("compression", compression)
    w.csv(path)
    return path


def read_csv(spark: SparkSession, path: str, schema: StructType | str | None = None,
             header: bool = True, null_value: str | None = None,
             min_partitions: int | None = None) -> DataFrame:
    """SRC-1..5: CSV with or without a header.

    ``schema`` gives names and types (headerless files get their names this
    way).  Without a schema the types are inferred, which reads the data an
    extra time.  ``null_value`` is the missing-value token (``?``).
    Compressed files (gzip) are not splittable, one task reads each file;
    ``min_partitions`` spreads the rows afterwards."""
    r = spark.read.option("header", header).option("mode", "FAILFAST")
    if null_value is not None:
        r = r.option("nullValue", null_value)
    if schema is None:
        r = r.option("inferSchema", True)
    else:
        r = r.schema(schema)
    df = r.csv(path)
    if min_partitions and df.rdd.getNumPartitions() < min_partitions:
        df = df.repartition(min_partitions)
    return df


def split_target(df: DataFrame, target_pos: int = -1, features: str = "features",
                 target: str = "target", keep: int = 0) -> DataFrame:
    """SRC-3 / SRC-4 / PRJ-4: the column at ``target_pos`` becomes the
    target, the other columns (after the first ``keep`` key columns) an
    array of doubles."""
    cols = df.columns
    t = cols[target_pos]
    keys = cols[:keep]
    xs = [c for c in cols[keep:] if c != t]
    return df.select(*keys, F.array(*[F.col(c).cast("double") for c in xs]).alias(features),
                     F.col(t).alias(target))


# -------------------------------------------------------- whole files ----

def write_file_per_key(df: DataFrame, path: str, name_col: str, text_col: str) -> str:
    """Write each row's text as its own file, in a folder named after
    ``name_col`` (Spark's partitioned layout: ``<path>/name=<value>/``)."""
    (df.select(F.col(name_col).cast("string").alias("name"), F.col(text_col).alias("value"))
       .repartition("name")
       .write.mode("overwrite").partitionBy("name").text(path))
    return path


def write_packed(df: DataFrame, path: str, name_col: str, text_col: str) -> str:
    """Write rows as (path, content) records: what a folder with a file for
    each row holds, in as many files as there are tasks."""
    (df.select(F.concat(F.lit("name="), F.col(name_col).cast("string"), F.lit("/part")).alias("path"),
               F.col(text_col).alias("content")).write.mode("overwrite").parquet(path))
    return path


def read_packed(spark: SparkSession, path: str, name_pattern: str, groups: dict[str, int]) -> DataFrame:
    """SRC-6 / SRC-9 over packed files: the fields of ``read_whole_files``,
    parsed from the ``path`` column."""
    raw = spark.read.schema("path string, content string").parquet(path)
    cols = [F.regexp_extract("path", name_pattern, g).alias(c) for c, g in groups.items()]
    return raw.select(*cols, F.col("content").alias("text"))


def read_whole_files(spark: SparkSession, path: str, name_pattern: str,
                     groups: dict[str, int]) -> DataFrame:
    """SRC-6 / SRC-9: one row per file, with fields parsed from its path.

    ``name_pattern`` is a regular expression applied to the full file path;
    ``groups`` maps output column -> capture group.  The text writer ends
    every record with a newline; that one character is removed."""
    # keyword form: ``text()`` resets an earlier ``option("wholetext")``
    raw = spark.read.text(path, wholetext=True, recursiveFileLookup=True)
    fp = F.col("_metadata.file_path")
    cols = [F.regexp_extract(fp, name_pattern, g).alias(c) for c, g in groups.items()]
    body = F.when(F.col("value").endswith("\n"),
                  F.expr("substring(value, 1, length(value) - 1)")).otherwise(F.col("value"))
    return raw.select(*cols, body.alias("text"))


# ----------------------------------------------------------------- JSON --

def write_json(df: DataFrame, path: str, mode: str = "overwrite") -> str:
    """SNK-2: one JSON document per line; nested structs and arrays kept."""
    df.write.mode(mode).json(path)
    return path


def read_json(spark: SparkSession, path: str, schema: StructType | str,
              multi_line: bool = False) -> DataFrame:
    return spark.read.schema(schema).option("multiLine", multi_line).json(path)

"""Registry of this package's queries and the few helpers its operators share."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from orrery.session import cut_lineage, scratch_path  # noqa: F401
from orrery.sources.tables import table  # noqa: F401

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

#: a word: a run of anything but the six ASCII white-space characters
WORD = r"[^\x20\x09-\x0D]+"


def query(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql.strip()
        return fn
    return deco


def text_or_empty(col: str | Column = "text") -> Column:
    c = F.col(col) if isinstance(col, str) else col
    return F.coalesce(c, F.lit(""))


def words(text: Column) -> Column:
    """Array of the words of a text (no empty strings)."""
    return F.filter(F.split(text, r"[\x20\x09-\x0D]+"), lambda w: F.length(w) > 0)


def quoted(name: str) -> str:
    """A column's name, whatever it holds, as ``F.col`` takes it."""
    return "`" + name.replace("`", "``") + "`"


def carried(df: DataFrame, text_col: str, drop: tuple[str, ...] = ()) -> tuple[DataFrame, list[str]]:
    """(row, text): the other columns in one struct, so that no name of
    theirs can clash with a kernel's, and the names that are kept."""
    names = [c for c in df.columns if c not in (text_col, *drop)]
    row = F.struct(*[F.col(quoted(c)).alias(c) for c in names]) if names else F.struct(F.lit(True).alias("none"))
    return df.select(row.alias("row"), F.col(quoted(text_col)).cast("string").alias("text")), names


def shuffle_partitions(spark: SparkSession) -> int:
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))

"""Session construction and cluster-safe helpers.

Nothing here hard-codes cluster facts: shuffle partitions, checkpoint
location and broadcast thresholds are read from the session when present.
"""

from __future__ import annotations

import atexit
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Defaults used only when the caller builds the session through us.
_DEFAULT_CONF = {
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # threads that fit models in parallel get their own copy of the local
    # properties (see models.fit_threads)
    "spark.localProperties.clone": "true",
}


def get_session(master: str | None = None, app: str = "orrery",
                shuffle_partitions: int | None = None,
                extra: dict | None = None) -> SparkSession:
    """Build (or reuse) a session with AQE and skew handling switched on."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for k, v in _DEFAULT_CONF.items():
        builder = builder.config(k, v)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (extra or {}).items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def is_local(spark: SparkSession) -> bool:
    """One process holds driver and executors, so a local folder is shared."""
    return spark.sparkContext.master.split("[")[0] == "local"


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder, honouring the cluster's setting.

    On a cluster ``spark.checkpoint.dir`` names a shared file system folder
    and is used as is.  Without it only a ``local[...]`` session (tests)
    gets a scratch folder; on any other master a machine-local folder would
    lose rows, so this raises.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = sc.getConf().get("spark.checkpoint.dir", None) or \
        spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if not is_local(spark):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        configured = tempfile.mkdtemp(prefix="orrery-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def scratch_path(spark: SparkSession, label: str = "t") -> str:
    """A new path under the shared checkpoint folder.  The paths of one
    application lie in one folder, which is removed when Python ends."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    top = f"{base}/orrery-tables/{spark.sparkContext.applicationId}"
    if top not in _TOPS:
        _TOPS.add(top)
        atexit.register(_remove_at_exit, spark, top)
    return f"{top}/{label}-{uuid.uuid4().hex}"


_TOPS: set[str] = set()


def remove_path(spark: SparkSession, path: str) -> None:
    """Delete a folder of the shared file system, if it is there."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def _remove_at_exit(spark: SparkSession, top: str) -> None:
    try:
        if spark.sparkContext._jsc is not None:
            remove_path(spark, top)
    except Exception:  # noqa: BLE001  the session is gone: the folder's owner cleans it
        pass


def cut_lineage(df: DataFrame, path: str | None = None) -> DataFrame:
    """Write ``df`` as a Parquet table under the shared checkpoint folder and
    read it back.

    Like a reliable checkpoint this survives lost executors and truncates
    lineage, but the re-read table carries file-size statistics.  A
    ``checkpoint()`` keeps the estimate of the plan it replaced, and in
    iterative joins (connected components) that estimate multiplies every
    round until planning itself runs out of memory.
    """
    spark = df.sparkSession
    path = path or scratch_path(spark)
    df.write.mode("overwrite").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


class Rounds:
    """Tables of an iteration: ``keep(df)`` writes the next one, and
    ``drop_old(n)`` deletes all but the newest ``n``."""

    def __init__(self, spark: SparkSession):
        self.spark, self.paths = spark, []

    def keep(self, df: DataFrame) -> DataFrame:
        self.paths.append(scratch_path(self.spark))
        return cut_lineage(df, self.paths[-1])

    def drop_old(self, n: int) -> None:
        old = self.paths[:-n] if n else self.paths
        self.paths = self.paths[-n:] if n else []
        for p in old:
            remove_path(self.spark, p)


def bounded_broadcast(df: DataFrame, max_rows: int) -> DataFrame:
    """Broadcast ``df`` only if it has at most ``max_rows`` rows.

    The count is an action on a side that is expected to be small (a
    vocabulary, a palette, centroids).  Beyond the bound the frame is
    returned unhinted and the join falls back to a shuffle join, which AQE
    may still turn into a broadcast when runtime statistics allow.
    """
    n = df.limit(max_rows + 1).count()
    return F.broadcast(df) if n <= max_rows else df


def small_side(df: DataFrame, max_rows: int = 10_000) -> DataFrame:
    """A table of group values made once (written to the checkpoint folder)
    and broadcast while it has at most ``max_rows`` rows; a larger one is
    joined by a shuffle."""
    return bounded_broadcast(cut_lineage(df), max_rows)


def many(df: DataFrame) -> DataFrame:
    """A side of a join with a row for each point or edge, never broadcast:
    files of few bytes may hold very many rows (equal numbers, ids in order),
    all of which the driver would gather."""
    return df.hint("merge")


def dbl(c, digits: int = 6):
    """Round a numeric column for stable comparison output."""
    return F.round(F.col(c) if isinstance(c, str) else c, digits)

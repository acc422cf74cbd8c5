"""Session helpers: the shared folder for checkpoints and intermediate tables."""

from __future__ import annotations

import tempfile
import threading
import uuid

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F

#: Rows for which a partition of an intermediate table of short rows is worth its task and files.
PART_ROWS = 4096

#: Whether a query's shuffle files go when it ends.
FREE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

_making = threading.Lock()
_local_roots: dict[str, str] = {}  # temporary folder per local application


def checkpoint_root(spark: SparkSession) -> str:
    """Folder named by ``spark.checkpoint.dir``.

    Only a local-mode session may go without the setting; it then gets a temporary folder. On a
    cluster a machine-local folder would be lost with its machine, so a missing setting is an error.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root
    sc = spark.sparkContext
    if not sc.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that every executor can reach")
    if sc.applicationId not in _local_roots:
        _local_roots[sc.applicationId] = tempfile.mkdtemp(prefix="starloom-")
    return _local_roots[sc.applicationId]


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Give ``DataFrame.checkpoint`` and the ALS trainer a reliable folder."""
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(checkpoint_root(spark))


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path below the shared folder for a written intermediate table."""
    return f"{checkpoint_root(spark).rstrip('/')}/starloom/{name}-{uuid.uuid4().hex}"


def cut_lineage(df: DataFrame) -> DataFrame:
    """Materialise ``df`` in the shared folder; it outlives the executors that computed it.

    Nothing reads its shuffles again, so their files go at once. Spark would keep them until the driver
    collects garbage, which on a long run of steps is the sum of all of them.
    """
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    with _making:  # the setting counts when a frame is made
        before = spark.conf.get(FREE_SHUFFLES)
        spark.conf.set(FREE_SHUFFLES, "true")
        try:
            last = df.select("*")
        finally:
            spark.conf.set(FREE_SHUFFLES, before)
    return last.checkpoint(eager=True)


def parts_for(n_rows: int) -> int:
    """Partitions that n_rows short rows fill."""
    return max(1, -(-n_rows // PART_ROWS))


def cut_and_count(df: DataFrame) -> tuple[DataFrame, int]:
    """``cut_lineage`` and the number of rows, counted on the way, in no more partitions than they fill.

    A shuffle writes files for every partition that it reads. A small table spread over all shuffle
    partitions thus costs files and tasks by their number, whatever its size.
    """
    seen = Observation()
    rows = cut_lineage(df.observe(seen, F.count(F.lit(1)).alias("n")))
    n_rows = seen.get["n"]
    return rows.coalesce(parts_for(n_rows)), n_rows

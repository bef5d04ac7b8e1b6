"""One place for session settings."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Settings every job relies on: UTC wall clock (timestamps without zone are
# read as UTC), adaptive execution (runtime coalescing, skew-join splitting,
# broadcast conversion from real sizes), Arrow for pandas exchange, no UI.
DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.localShuffleReader.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    # delete reliable checkpoint files once nothing references them
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app: str = "sparkwright", extra: dict | None = None) -> SparkSession:
    """Create (or reuse) a session with the library defaults.

    On a cluster, pass ``master=None`` and size ``shuffle_partitions`` to the
    data (about 128-256 MB of shuffle per partition); AQE coalesces from there.
    """
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    if extra:
        conf.update(extra)
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the reliable checkpoint directory, setting it only if unset.

    The cluster names a shared folder in ``spark.checkpoint.dir``; we read it
    from the session. Only a local-mode session without that setting (tests)
    gets a private folder of its own.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        sc.setCheckpointDir(configured)
        return sc.getCheckpointDir()
    if not sc.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir is not set; iterative jobs need a shared "
                           "checkpoint folder on a cluster")
    d = tempfile.mkdtemp(prefix="sparkwright-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    atexit.register(shutil.rmtree, d, ignore_errors=True)  # a local session's own folder goes with it
    sc.setCheckpointDir(d)
    return sc.getCheckpointDir()


class Copies:
    """Folders under the checkpoint folder that hold written copies of frames, counted by owner.

    A copy lives as long as somebody holds it: the block (:meth:`scope`) in which it was made, and every
    further reader that called :meth:`hold`. The last :meth:`release` deletes the folder. Copies made
    outside any block belong to the session and go with :func:`release_copies` or when the process ends.
    """

    def __init__(self):
        self.holders: dict[str, int] = {}
        self.blocks: list[list[str]] = [[]]

    def made(self, path: str) -> str:
        self.holders[path] = 1
        self.blocks[-1].append(path)
        return path

    def hold(self, path: str) -> None:
        if path not in self.holders:
            raise KeyError(f"no such copy: {path}")
        self.holders[path] += 1

    def release(self, spark: SparkSession, path: str) -> None:
        """Give up one hold; unknown (already deleted) copies are none of our business."""
        if path in self.holders:
            self.holders[path] -= 1
            if self.holders[path] <= 0:
                del self.holders[path]
                delete_folder(spark, path)

    @contextmanager
    def scope(self, spark: SparkSession):
        """The copies made inside are released at the end, also on failure."""
        self.blocks.append([])
        try:
            yield self
        finally:
            for path in self.blocks.pop():
                self.release(spark, path)


copies = Copies()


def release_copies(spark: SparkSession) -> None:
    """Job boundary: release every copy that belongs to no open block."""
    own, copies.blocks[0] = copies.blocks[0], []
    for path in own:
        copies.release(spark, path)


def delete_folder(spark: SparkSession, path: str) -> None:
    """Delete a folder in whatever file system the path names."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


def shared_path(spark: SparkSession, what: str) -> str:
    """A new folder under the checkpoint folder, which all executors share; registered as a copy."""
    return copies.made(f"{ensure_checkpoint_dir(spark)}/{what}-{uuid.uuid4().hex}")


def write_shared(df: DataFrame, what: str) -> DataFrame:
    """Write ``df`` once as Parquet under the checkpoint folder, which all executors share, and
    read it back: several readers see one materialisation, and no executor's disk holds the only
    copy. The copy belongs to the open block (see :class:`Copies`)."""
    path = shared_path(df.sparkSession, what)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def checkpointed(df: DataFrame) -> DataFrame:
    """A reliable checkpoint that keeps the partitions as they are; registered as a copy."""
    ensure_checkpoint_dir(df.sparkSession)
    out = df.checkpoint()
    copies.made(out._jdf.queryExecution().logical().rdd().getCheckpointFile().get())
    return out

"""Session set-up and the shared working folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

_RELEASED: ContextVar[list[str] | None] = ContextVar("released", default=None)
_INNERMOST: list[str] = []
CHECKPOINT_SETTING = "spark.checkpoint.dir"


def local_session(cores: str = "*", shuffle_partitions: int = 8) -> SparkSession:
    """A single-machine session for tests and the benchmark."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("lakeops")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        # The tables of one machine are small: smaller partitions keep all its cores busy.
        .config("spark.sql.adaptive.advisoryPartitionSizeInBytes", "4m")
        .getOrCreate()
    )


def shared_dir(spark: SparkSession) -> str:
    """The folder which every executor can reach, also set as checkpoint folder.

    The cluster names it in ``spark.checkpoint.dir``. Only a local session may fall back to a
    folder of this machine.
    """
    context = spark.sparkContext
    root = spark.conf.get(CHECKPOINT_SETTING, None) or context.getCheckpointDir()
    if root is None:
        if not context.master.startswith("local"):
            raise ValueError(f"set {CHECKPOINT_SETTING} to a folder shared by the cluster")
        root = tempfile.mkdtemp(prefix="lakeops-")
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(root)
    return root


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new, unused path under the shared folder."""
    return f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


@contextmanager
def scratch(spark: SparkSession) -> Iterator[list[str] | None]:
    """What ``written`` stores within the block, in this thread, is deleted at its end.

    For loads whose results are stored by then: nothing that is returned may read it. Gives the list of
    the block around it, to which ``written`` is told to add what is needed for longer.
    """
    paths: list[str] = []
    outer = _RELEASED.get()
    token = _RELEASED.set(paths)
    try:
        yield outer
    finally:
        _RELEASED.reset(token)
        for path in paths:
            folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
            folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)


def written(df: DataFrame, name: str, released: list[str] | None = _INNERMOST) -> DataFrame:
    """The same rows, written once as Parquet to the shared folder and read from there.

    For a result which several steps use: it is computed once, a lost executor does not take it
    along, and readers get its true size and only the columns they need. ``released`` is what ``scratch``
    gave, for a result that is to outlive its block.
    """
    path = scratch_path(df.sparkSession, name)
    paths = _RELEASED.get() if released is _INNERMOST else released
    if paths is not None:
        paths.append(path)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)

"""Session settings that suit these plans, and the shared checkpoint folder."""

import atexit
import contextlib
import posixpath
import uuid
import weakref
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession

# No side is broadcast on an estimate: joins are planned with a shuffle, and AQE turns
# one into a broadcast join once it has measured that the side is small.
# AQE sizes the shuffles, splits skewed join partitions and may pick a hash join
# for partitions that it has measured to be small.
# requireAllClusterKeysForCoPartition=false lets a join on (loan_id, month_end) keep
# a partitioning on loan_id, so loan-month frames are not shuffled a second time; a
# loan has one row per calendar month, so loan_id alone spreads them well.
SESSION_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": "64MB",
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "10MB",
    "spark.sql.requireAllClusterKeysForCoPartition": "false",
    "spark.sql.session.timeZone": "UTC",
    # plans here are built from many small expressions; skip the call-site capture for each
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


# Once a result is stored, the shuffle files behind it are of no more use.
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def build_session(app_name: str = "lendspan", master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**SESSION_CONF, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The checkpoint folder that the session names in `spark.checkpoint.dir`.

    Where it is unset the caller chooses one with `SparkContext.setCheckpointDir`.
    """
    context = spark.sparkContext
    if not context.getCheckpointDir():
        configured = spark.conf.get("spark.checkpoint.dir", None)
        if not configured:
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        context.setCheckpointDir(configured)
    return context.getCheckpointDir()


@contextlib.contextmanager
def dropping_shuffles(spark: SparkSession) -> Iterator[None]:
    """Writes in this block delete the shuffle files behind them as they end."""
    before = spark.conf.get(SHUFFLE_CLEANUP)
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.set(SHUFFLE_CLEANUP, before)


class Scratch:
    """Intermediate tables in one folder of the shared storage, deleted together.

    A stored result is computed once; later reads take only the columns they need and
    survive the loss of executors. Use it as a context manager where everything that
    reads the tables ends inside, or keep it until `release`.
    """

    def __init__(self, spark: SparkSession) -> None:
        self.spark = spark
        self.root = posixpath.join(shared_folder(spark), f"scratch-{uuid.uuid4().hex}")

    def store(self, df: DataFrame) -> DataFrame:
        path = posixpath.join(self.root, uuid.uuid4().hex)
        with dropping_shuffles(self.spark):
            df.write.option("compression", "zstd").parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def release(self) -> None:
        """Delete every table stored here; safe to call again."""
        _delete(self.spark, self.root)

    def drop(self, stored: DataFrame) -> None:
        """Delete one table stored here."""
        for path in {posixpath.dirname(f) for f in stored.inputFiles()}:
            if posixpath.basename(self.root) in path:
                _delete(self.spark, path)

    def __enter__(self) -> "Scratch":
        return self

    def __exit__(self, *_) -> None:
        self.release()


def _delete(spark: SparkSession, folder: str) -> None:
    context = spark.sparkContext
    path = context._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(context._jsc.hadoopConfiguration()).delete(path, True)


_BY_SESSION: "weakref.WeakKeyDictionary[SparkSession, Scratch]" = weakref.WeakKeyDictionary()


def session_scratch(spark: SparkSession) -> Scratch:
    """Scratch tables behind frames that are returned lazily; gone when the session ends."""
    held = _BY_SESSION.get(spark)
    if held is None:
        held = _BY_SESSION[spark] = Scratch(spark)
        atexit.register(_at_exit, spark)
    return held


def release_session(spark: SparkSession) -> None:
    """Delete what lazily returned frames read; for the end of a session."""
    held = _BY_SESSION.pop(spark, None)
    if held is not None and spark.sparkContext._jsc is not None:
        held.release()


def _at_exit(spark: SparkSession) -> None:
    with contextlib.suppress(Exception):  # the session's JVM may be gone already
        release_session(spark)


def materialise(df: DataFrame) -> DataFrame:
    """Write `df` once to the shared folder and read it back, until the session ends."""
    return session_scratch(df.sparkSession).store(df)

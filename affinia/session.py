"""Session settings and the shared folder for checkpoints and written intermediates."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Adaptive execution splits skewed join partitions and merges small ones, so
# shuffle.partitions is an upper bound to start from and not a tuned number.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.files.maxPartitionBytes": "128m",
}


#: Input bytes per shuffle partition, and the fewest partitions; adaptive execution merges small ones.
SHUFFLE_BYTES, SHUFFLES = 128 << 20, 200


def shuffles_for(input_bytes: int) -> int:
    """Shuffle partitions for an input, so that one fits into a task's memory at any size."""
    return max(SHUFFLES, -(-input_bytes // SHUFFLE_BYTES))


def build_session(name: str = "affinia", master: str | None = None, input_bytes: int | None = None, **extra: str) -> SparkSession:
    """A session with the library's settings; keyword names use ``__`` for the dots.

    ``input_bytes``, the size of what is going to be read, sets the shuffle partitions.
    """
    builder = SparkSession.builder.appName(name)
    if input_bytes is not None:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffles_for(input_bytes)))
    if master:
        builder = builder.master(master)
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    for key, value in extra.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, as the cluster names it.

    ``spark.checkpoint.dir`` is read from the session. Only a session of one process, as
    in tests, may fall back to a temporary folder; a cluster without the setting is an
    error, because a driver-local folder would be lost to the executors.
    """
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get(
        "spark.checkpoint.dir"
    )
    if named:
        if spark.sparkContext.getCheckpointDir() is None:
            spark.sparkContext.setCheckpointDir(named)
        return named
    current = spark.sparkContext.getCheckpointDir()
    if current:
        return current
    master = spark.sparkContext.master
    if master != "local" and not master.startswith("local["):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="affinia-"))
    return spark.sparkContext.getCheckpointDir()


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint: the rows survive lost executors and are never recomputed.

    The shuffle files that led to the rows go at once, and not when the driver happens to
    collect its garbage, so that a job holds those of one step at a time.
    """
    shared_dir(df.sparkSession)
    rows = df.checkpoint(eager=True)
    _release_shuffles(df)
    return rows


def _release_shuffles(df: DataFrame) -> None:
    """Removes the shuffle files of a plan that has run; should it run again, Spark writes them again."""
    plan = df._jdf.queryExecution().executedPlan()
    if plan.getClass().getSimpleName() == "AdaptiveSparkPlanExec":
        blocks = df.sparkSession._jvm.org.apache.spark.SparkEnv.get().blockManager().master()
        for shuffle in list(plan.context().shuffleIds().keySet()):
            blocks.removeShuffle(shuffle, False)


_scratch: list[str] = []


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder; ``clear_scratch`` removes what is written there."""
    _scratch.append(f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}")
    return _scratch[-1]


def clear_scratch(spark: SparkSession) -> int:
    """Deletes the intermediate tables of this process, once no result that reads them is needed any more."""
    gone = 0
    while _scratch:
        path = spark._jvm.org.apache.hadoop.fs.Path(_scratch.pop())
        gone += path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
    return gone

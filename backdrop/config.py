"""Session settings that the frame jobs rely on."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Frames are large rows (a 640x480 BGR frame is 900 KiB). Spark cuts the
# Arrow batches fed to ``mapInArrow`` by bytes as well as by rows, so a batch
# of large frames stays bounded while small frames still travel 10,000 rows
# at a time. 16 MiB measured faster than the 64 MiB default for 640x480
# frames (the working set of one batch stays in cache).
ARROW_BATCH_BYTES = 16 << 20
# What a small file counts for when files are dealt to tasks. With Spark's 4 MiB a
# task has about 30 of them, whatever they hold, and costs more than they do.
OPEN_COST_BYTES = 256 << 10
# Tasks at most of a listing. A file stream lists every file of a micro-batch
# by its own path, which Spark's 10,000 make a task each.
LISTING_TASKS = 64


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime SQL settings the frame operators assume.

    Only values still at Spark's default are changed, so a cluster that
    tuned them keeps its own choice.
    """
    conf = spark.conf
    if conf.get("spark.sql.execution.arrow.maxBytesPerBatch", None) in (None, "-1", "-1b", "67108864b"):
        conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(ARROW_BATCH_BYTES))
    if conf.get("spark.sql.files.openCostInBytes", None) in (None, "4MB", "4194304", "4194304b"):
        conf.set("spark.sql.files.openCostInBytes", str(OPEN_COST_BYTES))
    if conf.get("spark.sql.sources.parallelPartitionDiscovery.parallelism", None) in (None, "10000"):
        conf.set("spark.sql.sources.parallelPartitionDiscovery.parallelism", str(LISTING_TASKS))
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder for checkpoints and intermediate tables.

    The cluster names it in ``spark.checkpoint.dir``; only when that is unset
    in a local session (tests) a scratch folder is created and registered. On
    a cluster a folder of this machine would be unseen by the others.
    """
    path = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if path:
        return path
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    path = tempfile.mkdtemp(prefix="backdrop-ckpt-")
    spark.sparkContext.setCheckpointDir(path)
    try:  # also visible to readers of the setting; some sessions refuse core settings at runtime
        spark.conf.set("spark.checkpoint.dir", path)
    except Exception:  # noqa: BLE001 - the context's checkpoint dir is already set
        pass
    return spark.sparkContext.getCheckpointDir() or path


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to a new table in the shared folder and read back.

    Cuts the lineage: what is not deterministic (partition numbers, row places)
    is fixed, and a lost executor costs no recomputation of it.
    """
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def make_session(master: str | None = None, cores: int | None = None, app: str = "backdrop") -> SparkSession:
    """A local session for tests, benchmarks and examples."""
    if master is None:
        master = f"local[{cores}]" if cores else "local[*]"
    builder = (
        SparkSession.builder.master(master)
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", str(cores or os.cpu_count() or 8))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.sql.execution.arrow.maxBytesPerBatch", str(ARROW_BATCH_BYTES))
        .config("spark.driver.memory", os.environ.get("BACKDROP_DRIVER_MEMORY", "8g"))
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return configure(spark)

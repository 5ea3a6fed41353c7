"""Session settings and the one way this package cuts lineage."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession

# Runtime SQL settings every operator is written for.
RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a skewed join even where a later aggregate then needs its own shuffle.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # The JIT skips methods above 8000 bytes of bytecode; wide projections over text run faster split up.
    "spark.sql.codegen.hugeMethodLimit": "8000",
}

# Upper bounds; smaller values of a session stay. Columns of repeated words take few bytes a row in files and shuffles, so tasks
# of the usual 128 and 64 MB would hold ten million rows, and the map-side half of a duplicate removal gigabytes of them.
TASK_BYTES = 16 << 20
BOUNDS = ("spark.sql.files.maxPartitionBytes", "spark.sql.adaptive.advisoryPartitionSizeInBytes")


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to a session somebody else created."""
    for key, value in RUNTIME_CONF.items():
        spark.conf.set(key, value)
    for key in BOUNDS:
        if spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(spark.conf.get(key)) > TASK_BYTES:
            spark.conf.set(key, str(TASK_BYTES))
    return spark


def local_session(cpus: int | str = "*", shuffle_partitions: int = 8, **conf: str) -> SparkSession:
    """A local session for tests and the bench."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("carledger")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return configure(spark)


def shared_dir(spark: SparkSession) -> str:
    """The shared scratch folder: `spark.checkpoint.dir`, or where it is unset a temporary one, in one process only."""
    sc = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if folder is None:
        if sc.master != "local" and not sc.master.startswith("local["):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        folder = tempfile.mkdtemp(prefix="carledger-ckpt-")
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(folder)
    return folder


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint: survives the loss of executors."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)

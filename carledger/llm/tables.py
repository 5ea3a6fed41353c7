"""Stored steps and fixed-size filters shared by the corpus operators."""

from __future__ import annotations

import uuid

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from carledger.session import shared_dir

FILTER_BITS = 23  # a membership filter has 2^23 bits (1 MiB) unless told otherwise, whatever the number of keys
BATCH_BYTES = 8 << 20  # of an Arrow batch, or one row


def prepare(spark: SparkSession) -> SparkSession:
    """Texts are long: Arrow batches of a thousand of them, or of BATCH_BYTES, keep the buffers of a task small on both sides."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1000")
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    return spark


def stored(df: DataFrame) -> DataFrame:
    """Writes the rows once into the shared folder and reads them back, so that their size is known to the planner, a lost
    executor loses nothing, and row ids given on the way are fixed. The steps of an application lie in one folder, named by
    its id, which can go when it has ended."""
    spark = df.sparkSession
    path = f"{shared_dir(spark).rstrip('/')}/{spark.sparkContext.applicationId}/step-{uuid.uuid4().hex}"
    df.write.parquet(path)
    _STEPS.append(path)
    return spark.read.schema(df.schema).parquet(path)


_STEPS: list[str] = []  # folders that this process has stored


def steps() -> int:
    """How many steps have been stored so far."""
    return len(_STEPS)


def drop_steps(spark: SparkSession, since: int) -> None:
    """Deletes the folders of the steps stored since `since` but for the newest, which nothing else reads: for a run of stages in
    which each stage is stored as the next one's input, and no other thread stores steps meanwhile."""
    files = spark._jvm.org.apache.hadoop.fs.Path
    for path in _STEPS[since:-1]:
        files(path).getFileSystem(spark._jsc.hadoopConfiguration()).delete(files(path), True)
    del _STEPS[since:-1]


def narrow(df: DataFrame) -> DataFrame:
    """For rows of a few numbers, such as links: a sixteenth of the shuffle partitions, which are meant for whole texts."""
    return df.coalesce(max(1, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")) // 16))


def free_name(base: str, df: DataFrame) -> str:
    """A column name that the frame doesn't have."""
    while base in df.columns:
        base += "_"
    return base


def numbered(df: DataFrame, name: str = "_row") -> DataFrame:
    """Adds a row number that is unique, but only fixed once the frame is stored."""
    return df.withColumn(name, F.monotonically_increasing_id())


def fitting(keys: DataFrame, most: int) -> int:
    """Bits (as a power of two) of a filter with 16 bits a key, `most` at most."""
    return min(most, max(FILTER_BITS, (16 * keys.count()).bit_length()))


def membership(keys: DataFrame, key: str, bits: int = FILTER_BITS) -> np.ndarray:
    """A filter of 2^bits bits with the bit of each 64-bit key set; keys are hashes already. Spark sets the bits, the driver
    gets at most 2^bits / 32 numbers. More keys let more others through, and never lose one."""
    slots = keys.select(F.shiftrightunsigned(key, 64 - bits).alias("s")).select(
        F.shiftright("s", 5).cast("int").alias("word"), F.expr("shiftleft(1L, cast(s & 31 as int))").alias("bit")
    )
    found = slots.groupBy("word").agg(F.expr("bit_or(bit)").alias("bits")).toArrow()
    packed = np.zeros(1 << (bits - 5), np.uint32)
    packed[found["word"].to_numpy()] = found["bits"].to_numpy().astype(np.uint32)
    return packed


def may_hold(packed: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Whether each key (uint64) may be in the filter."""
    s = (keys >> np.uint64(64 - 4 - len(packed).bit_length())).astype(np.int64)
    return (packed[s >> 5] >> (s & 31).astype(np.uint32)) & np.uint32(1) != 0

"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# What the jobs rely on; sizes and memory stay with whoever runs the cluster.
DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}


MiB = 1024**2


def sized_for(input_bytes: int, cores: int, most: int | None = None) -> dict[str, str]:
    """Partition settings for a batch over ``input_bytes`` on ``cores``.

    Shuffles start from enough partitions to keep each near 256 MiB, which a
    task sorts in memory, and at least three per core; adaptive execution merges
    those that turn out small. The number grows with the input; a driver too
    small for the bookkeeping of so many can name the ``most`` it takes, at the
    price of larger partitions. 256 MiB is also the size of scan splits and of
    merged partitions, hence of the files a table is written in.
    """
    target = 256 * MiB
    partitions = max(input_bytes // target + 1, 3 * cores)
    if most:
        partitions = min(partitions, most)
    return {
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.sql.files.maxPartitionBytes": str(target),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target),
        "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
    }


def build_session(app: str = "larder", sizing: dict[str, str] | None = None, **conf: str) -> SparkSession:
    """Session with the defaults above, a sizing if given, and single options.

    Dots in option names are written as ``__``: ``spark__master="local[8]"``.
    """
    builder = SparkSession.builder.appName(app)
    options = DEFAULTS | (sizing or {}) | {k.replace("__", "."): v for k, v in conf.items()}
    for name, value in options.items():
        builder = builder.config(name, value)
    return builder.getOrCreate()


def remove_folder(spark: SparkSession, path: str) -> None:
    """Delete a folder that nothing reads any more, wherever it is stored."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


def scratch_folder(spark: SparkSession, purpose: str) -> str:
    """A new path in the shared folder named by ``spark.checkpoint.dir``.

    Only a local session may go without that setting: it falls back to a
    temporary folder, which other machines could not read.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        base = tempfile.mkdtemp(prefix="larder-")
    return f"{base.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"

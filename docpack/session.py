"""Session settings and tables kept in the folder that a whole cluster shares."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, StringType, StructField, StructType


def local_session(name: str = "docpack", cores: str = "*", partitions: int = 8) -> SparkSession:
    """A session for tests and benchmarks on one machine."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(name)
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder in ``spark.checkpoint.dir``; where it is unset (tests), a temporary one of this machine."""
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not found:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        found = tempfile.mkdtemp(prefix="spark-docpack-", dir="/tmp")
        spark.conf.set("spark.checkpoint.dir", found)
    return found.rstrip("/")


def small_batches(spark: SparkSession, most: int = 8 << 20) -> None:
    """Bounds what a Python worker takes at once where whole texts go to it, unless the session says otherwise."""
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    if spark.conf.get(name) == str((1 << 26)):  # Spark's default
        spark.conf.set(name, str(most))


def run_folder(spark: SparkSession, run: str | None = None) -> str:
    """Where the tables of this application, or of another one with the id ``run``, lie."""
    return f"{shared_dir(spark)}/docpack/{run or spark.sparkContext.applicationId}"


def new_path(spark: SparkSession, name: str) -> str:
    return f"{run_folder(spark)}/{name}-{uuid.uuid4().hex}"


def clean_up(spark: SparkSession, run: str | None = None) -> bool:
    """Deletes all tables that this application (or ``run``) has written between its steps; says whether there were any.

    Results are read from them, so store results first. Stores and archives need none of them.
    """
    folder = spark._jvm.org.apache.hadoop.fs.Path(run_folder(spark, run))
    return folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def written(df: DataFrame, name: str, narrow: bool = False) -> DataFrame:
    """``df`` as a Parquet table in the shared folder: its lineage is cut and survives lost executors.

    ``narrow`` is for rows of a few numbers: at most four files for each core, however many the shuffle partitions.
    """
    path = new_path(df.sparkSession, name)
    (df.coalesce(4 * df.sparkSession.sparkContext.defaultParallelism) if narrow else df).write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def spread(spark: SparkSession) -> int:
    """A power of two of hash buckets that grows with the cluster's shuffle partitions, not with one key's rows."""
    want = max(64, int(spark.conf.get("spark.sql.shuffle.partitions")) // 2)
    return min(1 << 16, 1 << (want - 1).bit_length())


def _width(field: StructField):
    """About how many bytes a value takes in memory, as a column."""
    kind, value = field.dataType, F.col(f"`{field.name}`")
    if isinstance(kind, StringType | BinaryType):
        return F.coalesce(F.octet_length(value), F.lit(0)) + 16
    if isinstance(kind, ArrayType):
        own = F.octet_length(F.concat_ws("", value)) if isinstance(kind.elementType, StringType) else F.lit(0)
        return F.coalesce(16 * F.greatest(F.size(value), F.lit(0)) + own, F.lit(0)) + 16
    return F.lit(32 if isinstance(kind, StructType) else 8)


def sided(df: DataFrame, most: int = 32 << 20) -> DataFrame:
    """``df`` (a written table) with a broadcast hint if its rows take at most ``most`` bytes; Spark shuffles it otherwise."""
    size = df.agg(F.sum(sum((_width(f) for f in df.schema), F.lit(16)).cast("long"))).first()[0] or 0
    return F.broadcast(df) if size <= most else df

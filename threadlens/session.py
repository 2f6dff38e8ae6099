"""Session settings and the shared folder for intermediate tables."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

SQL_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a skewed join partition even where that costs one more shuffle.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # Lets `row_number() <= n` drop rows before the shuffle for every cap in use (default stops at 1000).
    "spark.sql.optimizer.windowGroupLimitThreshold": "1000000",
}

_LOCAL_DIRS: dict[str, str] = {}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the run-time SQL settings the operators rely on."""
    for key, value in SQL_SETTINGS.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def build_session(app_name: str = "threadlens", master: str | None = None, **extra: str) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master is not None:
        builder = builder.master(master)
    for key, value in {**SQL_SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """Folder for intermediate tables: `spark.checkpoint.dir`, or a temporary one in local mode only."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    master = spark.conf.get("spark.master", "")
    if master != "local" and not master.startswith("local["):
        raise RuntimeError("set spark.checkpoint.dir to a folder that every executor can reach")
    app = spark.sparkContext.applicationId
    if app not in _LOCAL_DIRS:
        _LOCAL_DIRS[app] = tempfile.mkdtemp(prefix="threadlens-")
    return _LOCAL_DIRS[app]


def shared_path(spark: SparkSession, label: str) -> str:
    return f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"


def written(df: DataFrame, label: str = "step") -> DataFrame:
    """Write `df` once to the shared folder and read it back.

    Used where several branches read one costly result, or where a derived table joins a row table: the
    file size is then known when the join is planned, so Catalyst broadcasts it only below
    `spark.sql.autoBroadcastJoinThreshold` and shuffles (with skew splitting) above it.
    """
    path = shared_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def local_table(spark: SparkSession, rows: Sequence[tuple], schema: T.StructType) -> DataFrame:
    """A table from driver-side rows whose size the planner knows, so that joins to it broadcast on that size."""
    arrow = to_arrow_schema(schema)
    columns = [pa.array([r[i] for r in rows], arrow.field(i).type) for i in range(len(schema))]
    return spark.createDataFrame(pa.Table.from_arrays(columns, schema=arrow), schema)


def spread(scan: DataFrame) -> DataFrame:
    """Redistribute the rows of a plain file scan that has fewer partitions than cores; else leave it as it is.

    For text-heavy tables that arrive as a few unsplittable files. Call it on the scan itself: asking a frame
    with shuffles for its partition count would run them.
    """
    wanted = scan.sparkSession.sparkContext.defaultParallelism
    return scan.repartition(wanted) if scan.rdd.getNumPartitions() < wanted else scan

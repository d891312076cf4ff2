"""Session settings, the shared folder for intermediate tables, size checks."""

import contextlib
import os
import tempfile
import uuid
import zipfile

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# A table is broadcast (or gathered into a closure) only when it was measured
# to be under this many bytes.
BROADCAST_BYTES = 64 * 1024 * 1024


def build_session(app="newsloom", **conf):
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.sources.partitionOverwriteMode", "dynamic")
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    return ship_package(builder.getOrCreate())


_shipped = set()


def ship_package(spark):
    """Send this package to the executors, once per application, so that Python
    workers can import it whatever their working directory."""
    context = spark.sparkContext
    if context.applicationId not in _shipped:
        root = os.path.dirname(os.path.abspath(__file__))
        path = os.path.join(tempfile.mkdtemp(prefix="newsloom-package-"), "newsloom.zip")
        with zipfile.ZipFile(path, "w") as archive:
            for folder, _, names in os.walk(root):
                for name in sorted(names):
                    if name.endswith(".py"):
                        full = os.path.join(folder, name)
                        archive.write(full, os.path.relpath(full, os.path.dirname(root)))
        context.addPyFile(path)  # served by the driver
        _shipped.add(context.applicationId)
    return spark


def shared_dir(spark):
    """The folder that every executor can reach: spark.checkpoint.dir, or the
    checkpoint folder set on the context. Without either it is an error."""
    configured = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not configured:
        raise ValueError("set spark.checkpoint.dir to a folder all executors can reach")
    return configured


_owned = []


@contextlib.contextmanager
def scratch(spark):
    """Drop the intermediate tables that are written inside the block when it
    ends; results must be consumed before that."""
    paths = []
    _owned.append(paths)
    try:
        yield
    finally:
        _owned[:] = [p for p in _owned if p is not paths]
        for path in paths:
            hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
            hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(hadoop, True)


def fresh_path(spark, name: str) -> str:
    """A new path in the shared folder, dropped with the ``scratch`` block around it."""
    path = f"{shared_dir(spark)}/newsloom/{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex}"
    for paths in _owned[-1:]:
        paths.append(path)
    return path


def materialize(df: DataFrame, name: str, partition_by: str | None = None, rebalance: bool = True) -> DataFrame:
    """Write ``df`` to a new table in the shared folder and read it back.

    Cuts the lineage, survives lost executors, and keeps column pruning,
    filter pushdown and (with ``partition_by``) partition pruning. Without
    ``rebalance`` a partitioned table is written where its rows are, by each
    task a file per partition, which suits a few partitions.
    """
    spark = df.sparkSession
    path = fresh_path(spark, name)
    writer = df.write
    if partition_by:
        # rebalance lets AQE split a hot partition over several tasks and files
        writer = (df.hint("rebalance", partition_by) if rebalance else df).write.partitionBy(partition_by)
    writer.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def read_or_empty(spark, path: str, schema) -> DataFrame:
    """A Parquet table that may not have been written yet."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def row_bytes(df: DataFrame):
    """Rough bytes of one row as a column expression."""
    sizes = []
    for field in df.schema.fields:
        c = F.col(f"`{field.name}`")
        if isinstance(field.dataType, T.StringType):
            sizes.append(F.coalesce(F.octet_length(c), F.lit(0)) + 16)
        elif isinstance(field.dataType, T.ArrayType):
            sizes.append(F.coalesce(F.size(c), F.lit(0)) * 8 + 16)
        else:
            sizes.append(F.lit(16))
    return sum(sizes, F.lit(0)).cast("bigint")


def measured_bytes(df: DataFrame) -> int:
    return df.agg(F.coalesce(F.sum(row_bytes(df)), F.lit(0)).alias("b")).first()["b"]


def fits_broadcast(df: DataFrame, limit: int = BROADCAST_BYTES) -> bool:
    return measured_bytes(df) <= limit


def broadcast_if_small(df: DataFrame, store: str | None = None, limit: int = BROADCAST_BYTES) -> DataFrame:
    """Hint a broadcast after measuring the table; otherwise leave it to AQE.

    With ``store`` the table is written under that name first, so that what was
    costly to compute is computed once.
    """
    if store:
        df = materialize(df, store)
    return F.broadcast(df) if fits_broadcast(df, limit) else df

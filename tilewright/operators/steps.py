"""Steps of long jobs: shared checkpoints, and places in a global order without a task that holds all rows."""

from __future__ import annotations

import contextlib
import tempfile
import uuid
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def shared(spark: SparkSession) -> str:
    """The checkpoint folder: the cluster's, or where none is set a temporary one of a session on one machine alone."""
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if not folder and not sc.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        sc.setCheckpointDir(folder or tempfile.mkdtemp(prefix="spark-"))
    return sc.getCheckpointDir()


TASK_ROWS = 5000


def dealt(df: DataFrame, task_rows: int = TASK_ROWS) -> DataFrame:
    """df dealt out evenly, for work that costs far more than to move its rows: a table of a few MB may hold millions of rows and
    yet be one split. As many partitions as have task_rows each, which are counted before.

    Spark moves later filters, and the parsing that they ask for, before a repartition; not past the filter here, which
    all rows pass."""
    n = -(-df.count() // task_rows)
    return df.repartition(n).filter(F.monotonically_increasing_id() >= 0) if n > 1 else df


#: Paths that the innermost `scratch` deletes at its end
WRITTEN: list[list[str]] = []


def cut(df: DataFrame, batch_rows: int | None = None) -> DataFrame:
    """Writes df to the shared checkpoint folder and goes on from there, so that a lost executor costs no recomputation.

    batch_rows: Python tasks of df get so many rows at a time at most; whole texts are large, and a batch is held several
    times, by Spark outside its heap and by Python."""
    shared(df.sparkSession)
    with batches_of(df.sparkSession, batch_rows) if batch_rows else contextlib.nullcontext():
        out = df.checkpoint()
    if WRITTEN:
        WRITTEN[-1].append(out._jdf.queryExecution().logical().rdd().getCheckpointFile().get())
    return out


@contextlib.contextmanager
def batches_of(spark: SparkSession, rows: int) -> Iterator[None]:
    """What is run in this block hands Python so many rows at a time, or fewer if the session says so."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    if 0 < int(before) <= rows:
        yield
        return
    spark.conf.set(name, rows)
    try:
        yield
    finally:
        spark.conf.set(name, before)


def new_folder(spark: SparkSession, name: str) -> str:
    """A path in the shared folder that nothing has yet."""
    path = f"{shared(spark)}/{name}-{uuid.uuid4().hex}"
    if WRITTEN:
        WRITTEN[-1].append(path)
    return path


def delete(spark: SparkSession, path: str) -> None:
    """Deletes a file or folder, if it is there, in whatever file system it lies."""
    found = spark._jvm.org.apache.hadoop.fs.Path(path)
    found.getFileSystem(spark._jsc.hadoopConfiguration()).delete(found, True)


@contextlib.contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """What is cut, and what goes to new folders, in this block is deleted when the block ends well: for jobs whose results are
    written elsewhere by then. After an error all of it stays."""
    WRITTEN.append([])
    try:
        yield
    except BaseException:
        WRITTEN.pop()
        raise
    for path in WRITTEN.pop():
        delete(spark, path)


def in_order(df: DataFrame, *order: str | Column, place: str = "place", sums: dict[str, str] | None = None) -> DataFrame:
    """df with each row's place (from 0) in the order, and for each name of sums what a column adds up to before the row.

    Rows are dealt to partitions by ranges of the order and written, so that they stay where they are. Places and sums are
    counted within partitions; what lies before a partition comes from a table of one row a partition, the only one that a
    single task sees."""
    sums = sums or {}
    dealt = cut(df.repartitionByRange(*order).withColumn("_part", F.spark_partition_id()))
    upto = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)  # a row a partition
    totals = dealt.groupBy("_part").agg(F.count("*").alias("_n"), *(F.sum(c).alias(f"_{n}") for n, c in sums.items()))
    starts = totals.select("_part", *(F.coalesce(F.sum(c).over(upto), F.lit(0)).alias(c) for c in ("_n", *(f"_{n}" for n in sums))))
    here = Window.partitionBy("_part").orderBy(*order)
    before = here.rowsBetween(Window.unboundedPreceding, -1)
    joined = dealt.join(F.broadcast(starts), "_part")
    return joined.select(*df.columns, (F.row_number().over(here) - 1 + F.col("_n")).alias(place), *((F.coalesce(F.sum(c).over(before), F.lit(0)) + F.col(f"_{n}")).alias(n) for n, c in sums.items()))

"""Build-or-read tables."""

import datetime as dt
import uuid
from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

# What Spark reports for a folder that is absent, or left without data by an interrupted write.
NOT_BUILT = ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA")


def shared_path(spark: SparkSession, name: str) -> str:
    """A path in the folder that all executors share, named by ``spark.checkpoint.dir``.

    Only a session on this machine alone may leave it unset, and gets a folder by its application's id.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        context = getattr(spark, "sparkContext", None)
        if context is None or not context.master.startswith("local["):
            raise ValueError("spark.checkpoint.dir is not set; name a folder that all executors share")
        folder = f"/tmp/curveloom-shared/{context.applicationId}"
    return f"{folder.rstrip('/')}/{name}"


def own_path(spark: SparkSession, name: str) -> str:
    """A path in the shared folder that no other call gets, deleted with the ``scratch`` that it was asked for in."""
    path = shared_path(spark, f"{name}-{uuid.uuid4().hex}")
    for paths in _SCRATCH:
        paths.append(path)
    return path


def kept(df: DataFrame, name: str) -> DataFrame:
    """The rows, computed once into a table of the shared folder, without the lineage behind them.

    Use it where a plan reads an expensive result more than once. The table stays until the ``scratch`` around it ends, or
    the folder is cleared: results read from it lazily, so only the caller knows when they are done with.
    """
    path = own_path(df.sparkSession, name)
    write_table(df, path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


_SCRATCH: list[list[str]] = []


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Deletes the tables kept inside it when it is left. Use or write the results before that.

    ``with scratch(spark): query(spark, folder).write.parquet(path)``
    """
    paths: list[str] = []
    _SCRATCH.append(paths)
    try:
        yield
    finally:
        _SCRATCH.remove(paths)
        for path in paths:
            place = spark._jvm.org.apache.hadoop.fs.Path(path)
            place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def write_table(df: DataFrame, path: str, partition_by: Sequence[str] = (), mode: str = "errorifexists") -> None:
    df.write.mode(mode).partitionBy(*partition_by).parquet(path)


def materialize(
    spark: SparkSession, path: str, build: Callable[[], DataFrame], partition_by: Sequence[str] = (),
    refresh: bool = False,
) -> DataFrame:
    """The table at ``path``, built first if it is not finished or ``refresh`` is set.

    A table is finished when the small table ``path.state`` beside it says so. That is taken back before the first
    file is written and set after the last, so what an interrupted write leaves is built again. Any error other than
    "not built yet" is raised. The result reads from storage, so the lineage behind it is cut.
    """
    if refresh or not _finished(spark, path):
        try:
            spark.read.parquet(path)
        except AnalysisException as error:
            if error.getCondition() not in NOT_BUILT:
                raise  # there is something else that is not to be written over
        rows = build()
        _set_finished(spark, path, False)
        write_table(rows, path, partition_by, "overwrite")
        _set_finished(spark, path, True)
    return spark.read.parquet(path)


def extend(
    spark: SparkSession, path: str, build: Callable[[dt.date | None, DataFrame | None], tuple[DataFrame, DataFrame]],
) -> DataFrame:
    """The table at ``path`` with what ``build`` adds after its last date.

    ``build`` gets that date and the state that the last addition left, or twice None at first, and returns the rows of later
    dates and the state after them. Each addition is a folder of its own, and its date range a row of the manifest beside the
    table, written last: what an interrupted addition leaves is not listed, so it is not read, and is added again.
    """
    done = finished_ranges(spark, path)
    last = max(done, key=lambda r: r["number"], default=None)
    number = last["number"] + 1 if last else 0
    state = f"{path}.carried/added="
    rows, carried = build(last["end"] if last else None, spark.read.parquet(f"{state}{last['number']}") if last else None)
    write_table(rows, f"{path}/added={number}", mode="overwrite")
    span = spark.read.schema(rows.schema).parquet(f"{path}/added={number}").agg(F.min("date").alias("start"), F.max("date").alias("end")).first()
    if span["end"] is not None:
        write_table(carried, f"{state}{number}", mode="overwrite")
        entry = spark.range(1).select(F.lit(number).alias("number"), F.lit(span["start"]).alias("start"), F.lit(span["end"]).alias("end"))
        write_table(entry.coalesce(1), f"{path}.ranges", mode="append")
        done = [*done, {"number": number}]
    if not done:
        return spark.createDataFrame([], rows.schema)
    parts = [f"{path}/added={r['number']}" for r in done]
    return spark.read.schema(rows.schema).option("basePath", path).parquet(*parts).drop("added")


def finished_ranges(spark: SparkSession, path: str) -> list[Row]:
    """The manifest of an extended table, in order: ``number, start, end`` of each addition."""
    try:
        entries = spark.read.schema("number int, start date, end date").parquet(f"{path}.ranges")
        return entries.orderBy("number").collect()
    except AnalysisException as error:
        if error.getCondition() not in NOT_BUILT:
            raise
        return []


def _finished(spark: SparkSession, path: str) -> bool:
    try:
        states = spark.read.schema("finished boolean").parquet(f"{path}.state").collect()
    except AnalysisException as error:
        if error.getCondition() not in NOT_BUILT:
            raise
        return False
    return [s["finished"] for s in states] == [True]


def _set_finished(spark: SparkSession, path: str, finished: bool) -> None:
    write_table(spark.range(1).selectExpr(f"{str(finished).lower()} AS finished").coalesce(1), f"{path}.state", mode="overwrite")

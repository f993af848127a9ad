"""Sources and sinks: CSV, Parquet, Parquet globs, views, written cuts."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator, Mapping, Sequence
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import scratch_path

AIRPORTS_CSV = T.StructType(
    [
        T.StructField("airport_id", T.StringType()),
        T.StructField("lat", T.DoubleType()),
        T.StructField("lon", T.DoubleType()),
    ]
)

# Paths of the cuts written inside the innermost scope, if there is one.
_CUTS: ContextVar[list[str] | None] = ContextVar("cuts", default=None)

# Sides below this many narrow rows (some 20 MB) may be sent to every executor.
BROADCAST_ROWS = 200_000


def _csv_texts(
    spark: SparkSession, path: str, schema: T.StructType | str, sep: str, multiline: bool
) -> tuple[DataFrame, T.StructType]:
    """The columns of a schema as texts, by header name, and the schema."""
    if isinstance(schema, str):
        schema = T.StructType.fromDDL(schema)
    reader = spark.read.option("header", True).option("sep", sep).option("multiLine", multiline)
    rows = reader.csv(path)
    present = {name.strip().lower(): name for name in rows.columns}
    absent = [f.name for f in schema.fields if f.name.lower() not in present]
    if absent:
        raise ValueError(f"columns {absent} are not in the header {rows.columns} of {path}")
    return rows.select(*[F.col(f"`{present[f.name.lower()]}`").alias(f.name) for f in schema.fields]), schema


def read_csv(
    spark: SparkSession,
    path: str,
    schema: T.StructType | str = AIRPORTS_CSV,
    sep: str = ",",
    multiline: bool = False,
) -> DataFrame:
    """The columns of a schema out of CSV files with a header line, by name.

    The files' columns may stand in any order and be more; an absent one is an
    error. Values are cast to the schema's types, and what is no such value becomes
    NULL; ``malformed_cells`` reports these. No job runs to guess types, only one to read
    the header. ``multiline`` allows line ends inside quotes; a file is then one task's work.
    """
    texts, schema = _csv_texts(spark, path, schema, sep, multiline)
    return texts.select(*[F.col(f.name).try_cast(f.dataType).alias(f.name) for f in schema.fields])


def malformed_cells(
    spark: SparkSession,
    path: str,
    schema: T.StructType | str = AIRPORTS_CSV,
    sep: str = ",",
    multiline: bool = False,
) -> DataFrame:
    """(column_name, value, n): the cells that ``read_csv`` turns into NULL, and how often.

    Cells of all columns are looked at in one pass; only malformed ones go on to the grouping.
    """
    texts, schema = _csv_texts(spark, path, schema, sep, multiline)
    cells = [
        F.when(
            F.col(f.name).isNotNull() & F.col(f.name).try_cast(f.dataType).isNull(),
            F.struct(F.lit(f.name).alias("column_name"), F.col(f.name).alias("value")),
        )
        for f in schema.fields
    ]
    bad = texts.select(F.inline(F.array_compact(F.array(*cells))))
    return bad.groupBy("column_name", "value").agg(F.count(F.lit(1)).alias("n"))


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def read_parquet_glob(spark: SparkSession, pattern: str, base: str | None = None) -> DataFrame:
    """All Parquet files under a glob. ``base`` keeps the partition columns above it."""
    reader = spark.read if base is None else spark.read.option("basePath", base)
    return reader.parquet(pattern)


def write_parquet(
    df: DataFrame, path: str, partition_by: Sequence[str] = (), mode: str = "errorifexists"
) -> None:
    """Write Parquet; a path that exists is an error unless ``mode`` says otherwise.

    With partition columns the rows are rebalanced on them first: adaptive
    execution then splits a hot partition over many files of the advised size
    and joins the small ones, instead of one file per task and value.
    """
    if partition_by:
        df = df.hint("rebalance", *partition_by)
    df.write.mode(mode).partitionBy(*partition_by).parquet(path)


@contextmanager
def owned_cuts(spark: SparkSession) -> Iterator[Callable[[DataFrame, str], DataFrame]]:
    """A scope that deletes the cuts written inside it when it ends, also after a failure.

    What is made of these cuts must be written or collected before the end. Cuts of a
    scope inside go with that one; those written outside of any scope stay, as do all
    tables that the caller writes. The scope gives a ``materialize`` whose cut belongs to
    the scope around it.
    """
    own: list[str] = []
    outer = _CUTS.get()
    token = _CUTS.set(own)

    def kept(df: DataFrame, name: str) -> DataFrame:
        inner = _CUTS.set(outer)
        try:
            return materialize(df, name)
        finally:
            _CUTS.reset(inner)

    try:
        yield kept
    finally:
        _CUTS.reset(token)
        configuration = spark.sparkContext._jsc.hadoopConfiguration()
        for name in own:
            path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(name)
            path.getFileSystem(configuration).delete(path, True)


@contextmanager
def released_shuffles(spark: SparkSession) -> Iterator[None]:
    """A scope in which the shuffle files of a query go when it ends, not when the driver collects garbage.

    For chains of cuts: what a cut was made of is not read again.
    """
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name, "false")
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        spark.conf.set(name, before)


def materialize(df: DataFrame, name: str, partition_by: Sequence[str] = ()) -> DataFrame:
    """Write a table to the shared folder and read it back, to cut the plan there.

    Later steps then read files, also after executors were lost. The schema is
    known, so reading starts no job. The table stays until the scope of ``owned_cuts``
    around the call ends; without one, clearing the folder is the caller's business.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    own = _CUTS.get()
    if own is not None:
        own.append(path)
    write_parquet(df, path, partition_by)
    return spark.read.schema(df.schema).parquet(path)


def sql_over(spark: SparkSession, views: Mapping[str, DataFrame], text: str) -> DataFrame:
    """Register DataFrames as temporary views and run a SQL text over them.

    The text names a view as ``{name}``. Each call has view names of its own, so no view
    of the caller's is touched, and drops them when the plan is made.
    """
    names = {name: f"{name}_{uuid.uuid4().hex}" for name in views}
    for name, df in views.items():
        df.createOrReplaceTempView(names[name])
    try:
        return spark.sql(text.format(**names))
    finally:
        for name in names.values():
            spark.catalog.dropTempView(name)


def broadcast_if_small(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """Hint a broadcast only after counting; a larger side is left to shuffle joins.

    Meant for sides that are cheap to count, such as checkpointed ones.
    """
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df

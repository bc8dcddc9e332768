"""Reading and writing tables: catalog tables by name and parquet folders by path."""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wardflow.functions.dates import as_timestamp
from wardflow.sources import files
from wardflow.sources.snapshots import KEEP, RUN, SnapshotTable, Version, is_snapshot


def create_layers(spark: SparkSession, names: Sequence[str] = ("raw", "curated", "gold", "governance")) -> None:
    """One namespace per layer."""
    for name in names:
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {name}")


def create_table(spark: SparkSession, name: str, schema: T.StructType, path: str | None = None) -> None:
    """Create an empty parquet table with the declared columns and defaults, replacing an older one."""
    columns = []
    for field in schema:
        clause = f"{field.name} {field.dataType.simpleString()}"
        if not field.nullable:
            clause += " NOT NULL"
        if "default" in field.metadata:
            clause += f" DEFAULT {field.metadata['default']}"
        columns.append(clause)
    location = f" LOCATION '{path}'" if path else ""
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    spark.sql(f"CREATE TABLE {name} ({', '.join(columns)}) USING parquet{location}")


def rows_frame(
    spark: SparkSession, rows: Iterable[Sequence | Mapping], schema: T.StructType, columns: Sequence[str] | None = None
) -> DataFrame:
    """A frame from literal rows. Values may be text; columns left out take their declared default."""
    names = list(columns or schema.names)
    text = T.StructType([T.StructField(n, T.StringType()) for n in names])
    data = []
    for row in rows:
        values = [row.get(n) for n in names] if isinstance(row, Mapping) else list(row)
        if len(values) != len(names):
            raise ValueError(f"row has {len(values)} values for {len(names)} columns")
        data.append([None if v is None else str(v) for v in values])
    df = spark.createDataFrame(data, text)
    return df.select(*[_cell(f, f.name in names).alias(f.name, metadata=f.metadata) for f in schema])


def _cell(field: T.StructField, given: bool) -> Column:
    if given:
        col = F.col(field.name)
        return F.parse_json(col) if isinstance(field.dataType, T.VariantType) else col.cast(field.dataType)
    default = field.metadata.get("default")
    return (F.expr(default) if default else F.lit(None)).cast(field.dataType)


def append_rows(
    spark: SparkSession, table: str, rows: Iterable, schema: T.StructType, columns: Sequence[str] | None = None
) -> None:
    """Insert literal rows into a table."""
    append(rows_frame(spark, rows, schema, columns), table)


def append(df: DataFrame, target: str) -> None:
    """Append to a table name, to a folder made by ``ctas`` (as its next version), or to a plain parquet folder; an append
    to a plain folder feeds the streams that watch it."""
    if not _is_path(target):
        df.write.mode("append").format("parquet").saveAsTable(target)
    elif is_snapshot(df.sparkSession, target):
        SnapshotTable(df.sparkSession, target).append(df)
    else:
        df.write.mode("append").parquet(target)
        spark, root = df.sparkSession, target.rstrip("/")
        if files.exists(spark, _manifest(root)):
            _list_files(spark, root, [f"{root}/{file}" for file in _data_files(spark, root)])


def ctas(df: DataFrame, target: str, base_location: str | None = None, keep: int = KEEP) -> Version:
    """Create or replace a table (or folder) from a query, in one step.

    The rows are written beside those in force and take effect together, so a write that fails changes nothing and
    readers never see a part of either. A catalog table points at the folder of its newest version; below a plain path
    ``read`` looks the version up.
    """
    spark = df.sparkSession
    if _is_path(target):
        return SnapshotTable(spark, target, keep).replace(df)
    table = SnapshotTable(spark, base_location or _home_of(spark, target), keep)
    run, n = table.written(df, ())
    # The catalog is told before older folders are dropped, so the name always leads to rows that are there.
    _point(spark, target, df.schema, f"{table.root}/{RUN}={run}")
    return table.adopt(run, df.schema, (), n, {"table": target})


def _home_of(spark: SparkSession, name: str) -> str:
    """Where the versions of a catalog table lie that was given no place of its own."""
    database, _, table = name.rpartition(".")
    folder = spark.catalog.getDatabase(database or spark.catalog.currentDatabase()).locationUri
    return f"{folder.rstrip('/')}/{table}.versions"


def _point(spark: SparkSession, name: str, schema: T.StructType, folder: str) -> None:
    """Let a name stand for the rows of a folder. With the same columns the catalog changes in one step; otherwise the
    entry is made anew, which moves no rows."""
    if spark.catalog.tableExists(name):
        known = spark.table(name).schema
        same = [(f.name, f.dataType) for f in known] == [(f.name, f.dataType) for f in schema]
        if same and spark.catalog.getTable(name).tableType == "EXTERNAL":
            spark.sql(f"ALTER TABLE {name} SET LOCATION '{folder}'")
            spark.catalog.refreshTable(name)
            return
        spark.sql(f"DROP TABLE {name}")
    columns = T.StructType([T.StructField(f.name, f.dataType) for f in schema])
    spark.catalog.createTable(name, path=folder, source="parquet", schema=columns)


def export_open(df: DataFrame, base_location: str, name: str | None = None) -> str:
    """Publish a gold result as open parquet files at a location other engines can read.

    With a name the catalog points at the newest version. Without one the location is a plain folder of files: they are
    written out of sight, moved there, and ``_symlink_format_manifest/manifest``, which lists them one a line as several
    engines read it, is replaced as a whole; files of the time before go last. Those who read by the manifest, as ``read``
    does, never see a mixture, and a write that fails leaves all as it was.
    """
    spark, root = df.sparkSession, base_location.rstrip("/")
    if name:
        version = ctas(df, name, root)
        _list_files(spark, root, SnapshotTable(spark, root).frame(version, version.paths(root)).inputFiles())
        return base_location
    staging, before = f"{root}/_staging-{uuid.uuid4().hex}", _data_files(spark, root)
    moved: list[str] = []
    try:
        df.write.parquet(staging)
        for file in _data_files(spark, staging):
            files.move(spark, f"{staging}/{file}", f"{root}/{file}")
            moved.append(file)
        _list_files(spark, root, [f"{root}/{file}" for file in moved])
    except BaseException:
        for file in moved:
            files.delete(spark, f"{root}/{file}")
        raise
    finally:
        files.delete(spark, staging)
    for file in before:
        files.delete(spark, f"{root}/{file}")
    return base_location


def _data_files(spark: SparkSession, folder: str) -> list[str]:
    return [n for n in files.names(spark, folder) if not n.startswith(("_", "."))]


def _manifest(root: str) -> str:
    return f"{root}/_symlink_format_manifest/manifest"


def _list_files(spark: SparkSession, root: str, listed: Iterable[str]) -> None:
    files.write_text(spark, _manifest(root), "".join(f"{files.qualified(spark, f)}\n" for f in sorted(listed)))


def read(spark: SparkSession, target: str, schema: T.StructType | None = None) -> DataFrame:
    if not _is_path(target):
        return spark.table(target)
    if is_snapshot(spark, target):
        rows = SnapshotTable(spark, target).read()
        return rows if schema is None else rows.select(*schema.names)
    reader = spark.read.schema(schema) if schema is not None else spark.read
    manifest = _manifest(target.rstrip("/"))
    return reader.parquet(*(files.read_text(spark, manifest).split("\n")[:-1] if files.exists(spark, manifest) else [target]))


def _is_path(target: str) -> bool:
    return "/" in target


def with_lineage(df: DataFrame, batch_id: str, loaded_at: dt.datetime | str | Column | None = None) -> DataFrame:
    """All columns plus the load time and the batch the rows came with."""
    return df.select("*", as_timestamp(loaded_at).alias("loaded_at"), F.lit(batch_id).alias("batch_id"))


def table_columns(df: DataFrame) -> DataFrame:
    """The columns of a frame as rows: position, name, type. Work grows with the schema only."""
    rows = [(i, f.name.lower(), f.dataType.simpleString()) for i, f in enumerate(df.schema, 1)]
    return df.sparkSession.createDataFrame(rows, "ordinal int, column_name string, data_type string")


def read_whole_text(spark: SparkSession, path: str) -> DataFrame:
    """Every file below a path as one value."""
    return spark.read.text(path, wholetext=True).withColumnRenamed("value", "content")


def annotate(df: DataFrame, column: str, value: Column, target: str) -> DataFrame:
    """Set one column of every row and store the result at a new place (parquet files are never updated in place)."""
    type_ = df.schema[column].dataType if column in df.columns else None
    ctas(df.withColumn(column, value.cast(type_) if type_ is not None else value), target)
    return read(df.sparkSession, target)


def peek(df: DataFrame, n: int = 5) -> DataFrame:
    """Any n rows."""
    return df.limit(n)


def latest(df: DataFrame, n: int, ts: str, *tie_break: str) -> DataFrame:
    """The n newest rows; equal times are ordered by the tie-break columns. Runs as a distributed top-n."""
    return df.orderBy(F.col(ts).desc_nulls_first(), *[F.col(c).asc_nulls_last() for c in tie_break]).limit(n)


def register_views(spark: SparkSession, **frames: DataFrame) -> None:
    for name, df in frames.items():
        df.createOrReplaceTempView(name)

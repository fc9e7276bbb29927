"""Stored tables: scans, filtered history, appends, exports and row gates."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from datetime import date, timedelta

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.pandas.types import to_arrow_type

from ..constants import (
    DASHAIN_DAYS, DASHAIN_STARTS, HOLIDAY_YEARS, INDRA_JATRA, MOVING_HOLIDAYS, TIHAR_DAYS,
    TIHAR_STARTS, WARD_NAME, WARDS, YEARLY_HOLIDAYS,
)
from ..schemas import CALENDAR, WARDS as WARD_SCHEMA
from ..session import stored


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def spread(df: DataFrame) -> DataFrame:
    """One task per core for costly row work on inputs too small to be split that far.

    Inputs estimated at 4 MB per core, or more, are left alone, and so are streams.
    """
    if df.isStreaming:
        return df
    spark = df.sparkSession
    cores = spark.sparkContext.defaultParallelism
    size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    return df.repartition(cores) if size < cores * 4 * 1024 * 1024 else df


def run_sql(spark: SparkSession, sql: str, **views: DataFrame) -> DataFrame:
    """Ad-hoc SQL over frames passed by name."""
    return spark.sql(sql, **views)


def read_csv_dimension(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """CSV dimension with a header; a missing file gives an empty table."""
    jvm = spark.sparkContext._jvm
    hadoop_path = jvm.org.apache.hadoop.fs.Path(path)
    if not hadoop_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(hadoop_path):
        return spark.createDataFrame([], schema)
    return spark.read.csv(path, schema=schema, header=True)


def local_table(spark: SparkSession, rows: list[tuple], schema: T.StructType) -> DataFrame:
    """A few rows of fixed values as a local relation, whose size the planner knows."""
    columns = dict(zip(schema.names, map(list, zip(*rows))))
    return spark.createDataFrame(pa.table({n: pa.array(v, to_arrow_type(schema[n].dataType)) for n, v in columns.items()}), schema)


def default_wards(spark: SparkSession) -> DataFrame:
    return local_table(spark, [(i, WARD_NAME.format(i), lat, lon) for i, lat, lon in WARDS], WARD_SCHEMA)


def default_calendar(spark: SparkSession) -> DataFrame:
    """Festival and holiday days derived from first days, lengths and yearly dates."""
    spans = [(d, "Dashain", "is_dashain", DASHAIN_DAYS) for d in DASHAIN_STARTS]
    spans += [(d, "Tihar", "is_tihar", TIHAR_DAYS) for d in TIHAR_STARTS]
    spans += [(d, "Indra Jatra", "is_indra_jatra", 1) for d in INDRA_JATRA]
    spans += [(d, name, "is_public_holiday", 1) for name, days in MOVING_HOLIDAYS.items() for d in days]
    first, last = HOLIDAY_YEARS
    spans += [(f"{y}-{day}", name, "is_public_holiday", 1)
              for y in range(first, last + 1) for day, name in YEARLY_HOLIDAYS.items()]
    days = [(date.fromisoformat(start) + timedelta(days=i), name, flag) for start, name, flag, n in spans for i in range(n)]
    return local_table(spark, days, CALENDAR)


def history(
    df: DataFrame, ts: str, *, station: str | None = None, station_col: str = "station_id",
    start=None, end=None, asof=None, lookback: str | None = None, order: bool = False,
) -> DataFrame:
    """Optional filters with inclusive bounds; literal bounds reach the Parquet scan.

    ``lookback`` keeps rows from ``asof - lookback`` on; ``asof`` defaults to the
    newest time stored, so that a run can be repeated.
    """
    out = df
    if station is not None:
        out = out.where(F.col(station_col) == station)
    if start is not None:
        out = out.where(F.col(ts) >= F.lit(start))
    if end is not None:
        out = out.where(F.col(ts) <= F.lit(end))
    if lookback is not None:
        at = asof if asof is not None else df.agg(F.max(ts)).first()[0]
        out = out.where(F.col(ts) >= F.lit(at) - F.expr(f"interval {lookback}"))
    return out.orderBy(ts) if order else out


def sensor_rows(df: DataFrame, source: str = "source", value: str = "pm25", excluded: str = "kriging_interpolated") -> DataFrame:
    """Measured rows only: not interpolated and with a value."""
    return df.where((F.col(source) != excluded) & F.col(value).isNotNull())


def ensure_columns(df: DataFrame, wanted: dict[str, Column | float | bool | str | None]) -> DataFrame:
    """Add columns the frame lacks, with their defaults."""
    missing = {n: d if isinstance(d, Column) else F.lit(d) for n, d in wanted.items() if n not in df.columns}
    return df.withColumns(missing) if missing else df


def keep_available(df: DataFrame, names: Iterable[str]) -> DataFrame:
    return df.select(*[n for n in names if n in df.columns])


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Select by name in the order and types of the stored table; absent columns are NULL."""
    return df.select(*[
        (F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in schema.fields])


def append(df: DataFrame, path: str, schema: T.StructType, ts: str = "timestamp_utc", stamp: str = "ingested_at") -> None:
    """Append by name, stamped, one folder per day, rows of a station next to each other.

    The rebalance hint lets Spark split a hot day over several tasks and merge
    quiet ones, so neither giant nor thousands of small files appear.
    """
    stamped = df.withColumn(stamp, F.current_timestamp().cast("timestamp_ntz"))
    out = conform(stamped, schema).withColumn("date", F.to_date(ts))
    keys = [c for c in ("station_id",) if c in schema.names]
    out.hint("rebalance", "date").sortWithinPartitions("date", *keys, ts).write.mode("append").partitionBy("date").parquet(path)


def upsert(df: DataFrame, path: str, schema: T.StructType, keys: Sequence[str] = ("station_id", "timestamp_utc"), ts: str = "timestamp_utc",
           stamp: str = "ingested_at", run: str | None = None) -> None:
    """Write rows by key into day folders: of equal keys the newest stamp stays, so repeating a run changes no row count.

    Only days that the new rows touch are read and written again. The merged
    days are complete in the work folder before the table changes, and a run
    that was broken off is repaired by running it again; ``run`` names it in
    ``finished_runs`` once all its days are there. Keys must not be NULL.
    Rows of one key and stamp that differ leave the largest, column by column.
    """
    spark = df.sparkSession
    fresh = stored(conform(df.withColumn(stamp, F.current_timestamp().cast("timestamp_ntz")), schema).withColumn("date", F.to_date(ts)), "upsert-new")
    both, rest = fresh, [c for c in schema.names if c not in (*keys, stamp)]
    if has_rows(spark, path):
        # A day's folder is read only if the new rows have that day.
        old = spark.read.schema(fresh.schema).parquet(path)
        both = fresh.unionByName(old.join(fresh.select("date").distinct(), "date", "left_semi"))
    best = both.groupBy(*keys, "date").agg(F.max(F.struct(stamp, *rest)).alias("_row"))
    merged = stored(best.select(*keys, "date", "_row.*").select(*schema.names, "date"), "upsert-days")
    merged.hint("rebalance", "date").sortWithinPartitions("date", *keys).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("date").parquet(path)
    if run is not None:
        spark.range(1).select(F.lit(run).alias("run"), F.lit(fresh.count()).alias("n_rows")).coalesce(1).write.mode("overwrite").json(f"{path}/{RUNS}/{run}")


#: Markers of finished runs, beside the days; readers skip names that begin so.
RUNS = "_runs"


def has_rows(spark: SparkSession, path: str) -> bool:
    """Whether a table of day folders is there."""
    found = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{path}/date=*")
    return bool(len(found.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(found) or []))


def finished_runs(spark: SparkSession, path: str) -> DataFrame:
    """(run, n_rows) of the runs whose rows are all in the table."""
    jvm_path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{path}/{RUNS}")
    if not jvm_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(jvm_path):
        return spark.createDataFrame([], "run string, n_rows long")
    return spark.read.schema("run string, n_rows long").json(f"{path}/{RUNS}/*")


def read_day_table(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    return spark.read.parquet(path).select(*schema.names)


def export(df: DataFrame, path: str, fmt: str = "parquet") -> None:
    writer = df.write.mode("overwrite")
    if fmt == "csv":
        writer.option("header", True).csv(path)
    else:
        writer.format(fmt).save(path)


def row_gate(df: DataFrame, minimum: int = 168) -> DataFrame:
    """Row count and whether it reaches the minimum."""
    n = F.count(F.lit(1))
    return df.agg(n.alias("n_rows"), (n >= minimum).alias("enough"))


def require_rows(df: DataFrame, minimum: int = 168) -> None:
    if df.limit(minimum).count() < minimum:
        raise ValueError(f"fewer than {minimum} rows")

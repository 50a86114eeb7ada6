"""Table loads (K1-K3) and the period load policies (K6-K9).

Targets are parquet folders, catalog tables, or tables of a snapshot store
(``snapshots.Table``: loads are published by one file, see there).

* A truncate load is *staged*: the rows are written beside the target, counted
  by an observation on that write, and the target is switched to them by
  renames only when the write succeeded and there is something to load. A
  failed or empty load leaves the previous content untouched.
* Appends and month replacements go through Spark's file commit protocol.
  History tables are partitioned by ``mes`` (first day of the month) and
  replaced month by month (dynamic partition overwrite), so re-running a month
  close or a backfill never duplicates rows (the reference's day-1 existence
  probe could, see SURVEY D1). The overwrite mode is set per write.
"""

from __future__ import annotations

import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F, types as T

from ledgerspark.functions.dates import month_of
from ledgerspark.sinks.snapshots import Table

MONTH = "mes"


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """K3: the declared target columns, in order, cast to the declared types."""
    missing = [f.name for f in schema.fields if f.name not in df.columns]
    if missing:
        raise ValueError(f"missing target column(s) {missing}")
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])


def _is_path(target: str) -> bool:
    return "/" in target or ":" in target


@contextmanager
def _overwrite_mode(spark: SparkSession, mode: str):
    """The session's partition overwrite mode for the writes inside."""
    key = "spark.sql.sources.partitionOverwriteMode"
    before = spark.conf.get(key)
    spark.conf.set(key, mode)
    try:
        yield
    finally:
        spark.conf.set(key, before)


def _hadoop(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def _switch_folder(spark: SparkSession, staged: str, target: str) -> None:
    """Rename ``staged`` to ``target``; the old folder goes only when the new one stands."""
    fs, new = _hadoop(spark, staged)
    _, place = _hadoop(spark, target)
    _, old = _hadoop(spark, f"{target.rstrip('/')}.__old-{uuid.uuid4().hex}")
    had = fs.exists(place)
    if had and not fs.rename(place, old):
        raise OSError(f"cannot move {target} aside")
    if not fs.rename(new, place):
        if had:
            fs.rename(old, place)
        raise OSError(f"cannot switch {target} to the staged rows")
    if had:
        fs.delete(old, True)


def _switch_table(spark: SparkSession, staged: str, target: str) -> None:
    """The same for catalog tables."""
    old = f"{target}__old_{uuid.uuid4().hex}"
    had = spark.catalog.tableExists(target)
    if had:
        spark.sql(f"ALTER TABLE {target} RENAME TO {old}")
    try:
        spark.sql(f"ALTER TABLE {staged} RENAME TO {target}")
    except Exception:
        if had:
            spark.sql(f"ALTER TABLE {old} RENAME TO {target}")
        raise
    _follow_rename(spark, target)
    if had:
        spark.sql(f"DROP TABLE {old}")


def _follow_rename(spark: SparkSession, table: str) -> None:
    """Point the partitions of a renamed table into its folder (not every catalog does that itself)."""
    info = {r["col_name"]: r["data_type"] for r in spark.sql(f"DESCRIBE TABLE EXTENDED {table}").collect()}
    if "# Partition Information" not in info:
        return
    for row in spark.sql(f"SHOW PARTITIONS {table}").collect():
        spec = ", ".join("{}='{}'".format(*part.split("=", 1)) for part in row[0].split("/"))
        spark.sql(f"ALTER TABLE {table} PARTITION ({spec}) SET LOCATION '{info['Location'].rstrip('/')}/{row[0]}'")


def staged_write(df: DataFrame, target: str, write, skip_if_empty: bool = True, counted=None) -> bool:
    """Write ``df`` beside ``target`` with ``write(df, place)`` and switch on success.

    Rows (those where ``counted`` holds, if given) are counted on the write itself, so the plan
    runs once. Returns whether the target was switched.
    """
    spark = df.sparkSession
    seen = Observation(f"load-{uuid.uuid4().hex}")
    df = df.observe(seen, (F.count(F.lit(1)) if counted is None else F.count_if(counted)).alias("rows"))
    path = _is_path(target)
    staged = f"{target.rstrip('/')}.__new-{uuid.uuid4().hex}" if path else f"{target}__new_{uuid.uuid4().hex}"
    done = False
    try:
        with _overwrite_mode(spark, "static"):
            write(df, staged)
        if skip_if_empty and not seen.get.get("rows", 0):
            return False
        (_switch_folder if path else _switch_table)(spark, staged, target)
        done = True
        return True
    finally:
        if not done:
            if path:
                fs, p = _hadoop(spark, staged)
                fs.delete(p, True)
            else:
                spark.sql(f"DROP TABLE IF EXISTS {staged}")


def load(df: DataFrame, target: str | Table, mode: str = "overwrite", schema: T.StructType | None = None,
         skip_if_empty: bool = True, partition_by=None, fmt: str = "parquet", batch: tuple[str, int] | None = None) -> bool:
    """K1/K2: truncate-and-load (``overwrite``, staged) or ``append``.

    With ``skip_if_empty`` an empty result changes nothing (the reference's
    behaviour). ``batch`` (name, rising id) makes a load into a snapshot store happen
    once however often it is tried. Returns whether the target was written.
    """
    if schema is not None:
        df = conform(df, schema)
    if isinstance(target, Table):
        by = partition_by[0] if partition_by else None
        change = target.store.begin(batch)
        if mode == "overwrite":
            return change.overwrite(target.name, df, skip_if_empty, fmt, by).commit()
        return change.append(target.name, df, fmt, by).commit()
    if batch is not None:
        raise ValueError("a batch needs a snapshot store's table as its target: a plain folder has no ledger")

    def write(rows: DataFrame, place: str) -> None:
        w = rows.write.mode(mode).format(fmt)
        if partition_by:
            w = w.partitionBy(*partition_by)
        w.save(place) if _is_path(place) else w.saveAsTable(place)

    if mode == "overwrite":
        return staged_write(df, target, write, skip_if_empty)
    seen = Observation(f"load-{uuid.uuid4().hex}")
    write(df.observe(seen, F.count(F.lit(1)).alias("rows")), target)  # no rows append nothing
    return not skip_if_empty or seen.get.get("rows", 0) > 0


def with_month(df: DataFrame, date_col: str) -> DataFrame:
    return df.withColumn(MONTH, month_of(F.col(date_col)))


def replace_months(df: DataFrame, target: str | Table, date_col: str, fmt: str = "parquet",
                   drop_date: bool = False) -> bool:
    """K6/K7/K9: write rows into ``target`` partitioned by month, replacing only
    the months present in ``df`` (idempotent re-runs).

    With dynamic partition overwrite an empty input replaces no partition, so the
    old content stays; a catalog table that exists is inserted into, never
    replaced. The rows written are counted by an observation on the write itself
    (no extra job). Returns whether any row was written.
    """
    out = with_month(df, date_col)
    if drop_date:
        out = out.drop(date_col)
    if isinstance(target, Table):
        return target.store.begin().replace(target.name, out, MONTH).commit()
    spark = out.sparkSession
    obs = Observation(f"months-{uuid.uuid4().hex}")
    # No repartition by month: that would put a whole month into one task.
    # Each task writes the months it holds; the commit makes them visible at once.
    with _overwrite_mode(spark, "dynamic"):
        if not _is_path(target) and spark.catalog.tableExists(target):
            out = out.select(*spark.table(target).columns)
            out = out.observe(obs, F.count(F.lit(1)).alias("rows"))
            out.write.mode("overwrite").insertInto(target)
        else:
            out = out.observe(obs, F.count(F.lit(1)).alias("rows"))
            w = out.write.mode("overwrite").format(fmt).partitionBy(MONTH)
            w.save(target) if _is_path(target) else w.saveAsTable(target)
    return obs.get.get("rows", 0) > 0

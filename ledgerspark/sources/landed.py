"""Projected, filtered, optionally limited scan of a landed ERP model.

ERP extraction lands records as JSON lines or parquet with an explicit schema
(no inference) and a ``_seq`` source-order column. The reference's offset
pagination becomes Spark's file splits; its remote domain becomes ``where``
predicates that Catalyst pushes into the parquet scan.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from ledgerspark.operators.dedup import SEQ


def loose_schema(schema: T.StructType) -> T.StructType:
    """``schema`` with every scalar but booleans and ``_seq`` as text.

    An ERP writes ``false`` for any empty field, numbers included; as text it
    passes, and the normalisers (X10, X11, X12) turn it into 0 or null.
    """
    loose = (T.NumericType, T.StringType, T.DateType, T.TimestampType, T.TimestampNTZType)
    return T.StructType([T.StructField(f.name, T.StringType() if isinstance(f.dataType, loose) and f.name != SEQ
                                       else f.dataType) for f in schema.fields])


#: Rows of a row group from which on it is worth an exchange to share them out.
SPREAD_ROWS = 10_000


def _row_groups(spark: SparkSession, files: Sequence[str]) -> list[int]:
    """Rows of every row group of some Parquet files, from their footers."""
    conf = spark._jsc.hadoopConfiguration()
    hadoop, parquet = spark._jvm.org.apache.hadoop.fs, spark._jvm.org.apache.parquet.hadoop
    found = []
    for file in files:
        reader = parquet.ParquetFileReader.open(
            parquet.util.HadoopInputFile.fromPath(hadoop.Path(spark._jvm.java.net.URI(file)), conf))
        try:
            found += [b.getRowCount() for b in reader.getRowGroups()]
        finally:
            reader.close()
    return found


def spread(df: DataFrame) -> DataFrame:
    """A Parquet scan whose rows every core gets a share of.

    A row group is read by one task. Where a table has fewer of them than the session
    has cores (footers of as many files are read at most), the rows that the query's
    pushed filters and projection leave are dealt out by one exchange, so the parsing
    behind it runs on all cores. Larger tables are read as they are, without an exchange.
    """
    spark = df.sparkSession
    cores, files = spark.sparkContext.defaultParallelism, df.inputFiles()
    if len(files) >= cores:
        return df
    groups = _row_groups(spark, files)
    return df.repartition(cores) if len(groups) < cores and max(groups, default=0) >= SPREAD_ROWS else df


def read_landed(spark: SparkSession, path: str, schema: T.StructType,
                fmt: str = "parquet") -> DataFrame:
    """Read a landed table: parquet with its declared schema, JSON lines loosely typed (``loose_schema``).

    In JSON, unknown fields are ignored; a malformed line fails the job instead
    of silently turning into "no data" (the reference returned []). A parquet table of
    few row groups is dealt to all cores (``spread``).
    """
    if fmt == "json":
        return spark.read.schema(loose_schema(schema)).option("mode", "FAILFAST").json(path)
    df = spark.read.schema(schema).format(fmt).load(path)
    return spread(df) if fmt == "parquet" else df


def fetch(df: DataFrame, fields: Sequence[str] | None = None,
          where: Column | None = None, limit: int | None = None) -> DataFrame:
    """Projected scan: ``fields`` (+ ``_seq``), a predicate, and a row limit.

    ``limit`` None or 0 means all rows. A limit keeps the first rows in source
    order (a take-ordered plan: each task keeps at most ``limit`` rows).
    """
    if where is not None:
        df = df.where(where)
    if fields is not None:
        keep = list(dict.fromkeys(list(fields) + ([SEQ] if SEQ in df.columns else [])))
        df = df.select(*keep)
    if limit:
        order = F.col(SEQ) if SEQ in df.columns else None
        if order is None:
            raise ValueError("a limited extract needs the _seq column to be deterministic")
        df = df.orderBy(order).limit(int(limit))
    return df


def text_on_or_after(col: str, day) -> Column:
    """``col >= day`` on an ISO date/datetime text column, pushable to the scan.

    ISO text sorts like the date it holds; the ``rlike`` guard keeps marker
    text such as ``false`` (which sorts after digits) out.
    """
    d = str(day)[:10]
    return (F.col(col) >= F.lit(d)) & F.col(col).rlike(r"^\d{4}-\d{2}-\d{2}")


# What an ERP lands for an empty date (any case); such rows have no date.
EMPTY_DATES = ("", "false", "none", "nan", "nat", "null")


def strict_on_or_after(col: str, day) -> Column:
    """``text_on_or_after`` that raises on text that is no date.

    The comparison with ``day`` stands alone as well, so it still reaches the scan;
    text that sorts before ``day`` is outside the extract, as at the source, and
    is not looked at. Nulls and the empty-field markers match nothing.
    """
    c, d = F.col(col), F.lit(str(day)[:10])
    good = c.rlike(r"^\d{4}-\d{2}-\d{2}") & F.substring(c, 1, 10).try_cast("date").isNotNull()
    empty = F.lower(F.trim(c)).isin(*EMPTY_DATES)
    checked = F.when(good, F.lit(True)).when(empty, F.lit(False)).otherwise(
        F.raise_error(F.concat(F.lit(f"unparsable date in {col}: "), c)).cast("boolean"))
    return (c >= d) & F.when(c >= d, checked).otherwise(F.lit(False))


def text_on_or_before(col: str, day) -> Column:
    """``col <= day`` (whole day inclusive) on ISO date/datetime text."""
    d = str(day)[:10]
    return (F.col(col) < F.lit(d + "~")) & F.col(col).rlike(r"^\d{4}-\d{2}-\d{2}")

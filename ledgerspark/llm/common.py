"""Shared pieces of the training-data operators: scratch tables, hold-out rule, bounded filters."""

from __future__ import annotations

import os
import re
import tempfile
import uuid
import zipfile

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Words of a text: maximal runs of anything but ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"
BATCH_BYTES = 8 << 20
#: Internal id of rows without doc_id; it sorts after every real id.
NO_ID = 2**63 - 1


def scratch(spark: SparkSession) -> str:
    """Folder for intermediate tables: ``spark.checkpoint.dir``.

    Where that is unset, a local session gets a temporary folder; on a cluster
    a machine-local folder would lose data, so it is an error there.
    """
    sc = spark.sparkContext
    folder = sc.getConf().get("spark.checkpoint.dir") or sc.getCheckpointDir()
    if not folder:
        if not (sc.master.startswith("local[") or sc.master == "local"):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        folder = "file://" + tempfile.mkdtemp(prefix="ledgerspark-llm-")
        sc.setCheckpointDir(folder)
    if "://" not in folder:  # a bare path belongs to the cluster's default file system, for every reader alike
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        folder = path.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(path).toString()
        folder = re.sub(r"^file:/(?!//)", "file:///", folder)
    return folder.rstrip("/")


def ship(spark: SparkSession) -> None:
    """Send this package to the Python workers, once a context, so that nothing has to be installed there.

    Arrow batches are held to 8 MB, which bounds what a worker and its JVM keep of a batch.
    """
    sc = spark.sparkContext
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)
    if getattr(sc, "_ledgerspark_shipped", False):
        return
    top = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    out = os.path.join(tempfile.mkdtemp(prefix="ledgerspark-zip-"), "ledgerspark.zip")
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
        for folder, _, names in os.walk(top):
            for name in sorted(names):
                if name.endswith(".py"):
                    path = os.path.join(folder, name)
                    z.write(path, os.path.relpath(path, os.path.dirname(top)))
    sc.addPyFile(out)
    sc._ledgerspark_shipped = True


def new_path(spark: SparkSession, name: str) -> str:
    """A path in the shared folder that nothing has used."""
    return f"{scratch(spark)}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as Parquet to the shared folder and read back: its lineage ends there."""
    spark = df.sparkSession
    path = new_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def internal_id(col: str = "doc_id") -> Column:
    """doc_id with null replaced by an id that sorts last."""
    return F.coalesce(F.col(col).cast("long"), F.lit(NO_ID))


def external_id(col: Column) -> Column:
    """The inverse of :func:`internal_id`."""
    return F.when(col != NO_ID, col)


def held_out(col: str = "doc_id") -> Column:
    """True where crc32(doc_id as text) mod 4 is 2; null ids are held out too."""
    return F.coalesce(F.crc32(F.col(col).cast("string").cast("binary")) % 4 == 2, F.lit(True))


EXTRAS = "__extras"


def packed(docs: DataFrame, *reads: str) -> DataFrame:
    """The columns of ``docs`` that an operator reads, and all others in one struct: no name of theirs can clash with its own."""
    others = [F.col(f"`{c}`") for c in docs.columns if c not in reads]
    return docs.select(*reads, (F.struct(*others) if others else F.lit(True)).alias(EXTRAS))


def unpacked(rows: DataFrame, docs: DataFrame, *reads: str, leave: tuple[str, ...] = ()) -> list[Column]:
    """The columns of ``docs`` (but those to ``leave`` out), in their order, from rows that ``packed`` made."""
    return [rows[c] if c in reads else rows[EXTRAS].getField(c).alias(c) for c in docs.columns if c not in leave]


def schema_with(rows: DataFrame, name: str, kind: T.DataType) -> T.StructType:
    """The schema of ``rows`` and one more column."""
    return T.StructType([*rows.schema.fields, T.StructField(name, kind)])


def keyed(docs: DataFrame) -> DataFrame:
    """``docs`` plus ``__id`` (internal id) and ``__key`` (hash of the whole text).

    The pair names a text even where ids repeat: rows with equal pairs are copies.
    """
    ship(docs.sparkSession)
    return docs.select("*", internal_id().alias("__id"), F.xxhash64("text").alias("__key"))


#: Longs in a bit map (2 MB whatever the input).
BITMAP_WORDS = 1 << 18


def bitmap(rows: DataFrame, *cols: str) -> DataFrame:
    """Bit map of the hashed values of ``cols``: at most 2^18 longs at any input size.

    It lets a scan drop rows that cannot join before they are shuffled. It has no
    false negatives; where the input outgrows it, it only drops less.
    """
    h = F.pmod(F.xxhash64(*cols), F.lit(BITMAP_WORDS * 64))
    bits = F.bit_or(F.expr("shiftleft(1L, cast(__h % 64 as int))"))
    return written(rows.select(h.alias("__h")).groupBy(F.expr("cast(__h div 64 as int)").alias("__w")).agg(bits.alias("__bits")), "bitmap")


def marked(df: DataFrame, bits: DataFrame, *cols: str) -> DataFrame:
    """``df`` plus ``__hit``: false where the bit map rules the row out. Broadcasts the bit map (bounded)."""
    h = F.pmod(F.xxhash64(*cols), F.lit(BITMAP_WORDS * 64))
    df = df.withColumn("__h", h).withColumn("__w", F.expr("cast(__h div 64 as int)"))
    hit = F.expr("coalesce((shiftright(__bits, cast(__h % 64 as int)) & 1L) = 1L, false)")
    return df.join(F.broadcast(bits), "__w", "left").withColumn("__hit", hit).drop("__h", "__w", "__bits")


def bounded_sample(rows: DataFrame, most: int, col: str = "doc_id") -> DataFrame:
    """At most ``most`` rows, those with the least hash of ``col``: the same at every layout."""
    return rows.orderBy(F.xxhash64(col), col).limit(most)


def training_labels(labels: DataFrame, target: str) -> DataFrame:
    """doc_id and 0/1 ``target`` of the rows that may be learnt from: not held out, one per id (the larger label)."""
    rows = labels.where(~held_out("doc_id") & F.col(target).isNotNull())
    return rows.groupBy("doc_id").agg(F.max(F.col(target).cast("int")).alias(target))

"""Tag names from a tag *table* (X8 when the id -> name map is data, not a dict)."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ledgerspark.functions.relations import tag_ids


def tag_names_from_table(df: DataFrame, col: str, tags: DataFrame, out: str,
                         key: str = "id", name: str = "name", row_key: str = "_seq") -> DataFrame:
    """Add ``out``: names of the ids in ``col`` looked up in ``tags``, joined by ", ".

    One plan at any size: the tag table is first reduced to one row per id (of
    several names the greatest), ids are exploded with their position, joined, and each
    row's list is rebuilt, grouped by ``row_key`` (each group holds one row's ids
    only). Order kept; unknown ids and empty names dropped; no list -> "".
    """
    dtype = df.schema[col].dataType
    one = (tags.select(F.col(key).cast("bigint").alias("_tag"), F.col(name).cast("string").alias("_name"))
           .groupBy("_tag").agg(F.max("_name").alias("_name")))
    exploded = df.select(row_key, F.posexplode(tag_ids(F.col(col), dtype)).alias("_pos", "_tag"))
    named = exploded.join(one.where(F.col("_name") != ""), "_tag")
    per_row = (named.groupBy(row_key)
               .agg(F.array_sort(F.collect_list(F.struct("_pos", "_name"))).alias("_pairs"))
               .select(row_key, F.array_join(F.transform("_pairs", lambda p: p["_name"]), ", ")
                       .alias(out)))
    return (df.join(per_row, row_key, "left")
            .withColumn(out, F.coalesce(F.col(out), F.lit(""))))

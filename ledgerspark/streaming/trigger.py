"""``run_on_new_landings``: run a batch job when new raw files have landed."""

from __future__ import annotations

from typing import Callable

from pyspark.sql import DataFrame, SparkSession, types as T

from ledgerspark.session import checkpoint_dir
from ledgerspark.sinks.snapshots import Table


def run_on_new_landings(spark: SparkSession, landing_path: str, schema: T.StructType,
                        job: Callable[[DataFrame, int], None], name: str,
                        fmt: str = "json") -> list[int]:
    """Run ``job(new_rows, batch_id)`` for each micro-batch of newly landed files.

    ``trigger(availableNow=True)`` processes everything landed since the last
    run and then stops, so this fits a scheduled daily run. Progress is kept
    in ``<spark.checkpoint.dir>/streams/<name>``: a re-run after a failure
    resumes at the first unfinished batch, and a batch whose job failed is
    retried, so a job may see a batch again (at least once). Returns the ids of the batches that carried rows.
    """
    ckpt = f"{checkpoint_dir(spark).rstrip('/')}/streams/{name}"
    done: list[int] = []

    def on_batch(batch: DataFrame, batch_id: int) -> None:
        if batch.isEmpty():
            return
        job(batch, batch_id)
        done.append(batch_id)

    stream = spark.readStream.schema(schema).format(fmt).load(landing_path)
    query = (stream.writeStream.foreachBatch(on_batch)
             .option("checkpointLocation", ckpt)
             .trigger(availableNow=True)
             .start())
    query.awaitTermination()
    return done


def append_new_landings(spark: SparkSession, landing_path: str, schema: T.StructType, target: Table, name: str,
                        transform: Callable[[DataFrame], DataFrame] = lambda rows: rows, fmt: str = "json",
                        by: str | None = None) -> list[int]:
    """Append the transformed rows of newly landed files to a snapshot table, each file exactly once.

    A micro-batch that is tried again has the same files and the same id; the id is published
    with the rows in the table's ledger, so a retry after a failure at any step appends nothing twice.
    """
    def append(rows: DataFrame, batch_id: int) -> None:
        target.store.begin((f"stream-{name}", batch_id)).append(target.name, transform(rows), by=by).commit()

    return run_on_new_landings(spark, landing_path, schema, append, name, fmt)

"""Increments, mirrors, the two-table close, the resumable backfill and exactly-once appends."""

import json
import random
import uuid

import pytest
from pyspark.sql import functions as F

from ledgerspark import schemas
from ledgerspark.operators import keep_first
from ledgerspark.operators.increments import changed_since, merge, mirror, state
from ledgerspark.plans import incremental as inc, jobs, transforms as tf
from ledgerspark.sinks import snapshots
from ledgerspark.sinks.snapshots import Conflict, Snapshots
from ledgerspark.sources import invoices_raw, orders_raw
from ledgerspark.streaming import append_new_landings


@pytest.fixture
def store(spark, tmp_path):
    return Snapshots(spark, f"file://{tmp_path}/store")


def listed(df):
    return sorted(map(tuple, df.collect()), key=repr)


def keyed_rows(spark, seed=1, n=400):
    """A third of all rows share a key; keys may be null, in part or in full."""
    rng = random.Random(seed)
    rows = [(i, "hot" if i % 3 == 0 else rng.choice([None, *"abcdefgh"]), rng.choice([None, 1, 2]), f"v{rng.random()}") for i in range(n)]
    rng.shuffle(rows)
    return spark.createDataFrame(rows, "_seq long, k string, j int, v string")


@pytest.mark.parametrize("seed", [1, 2])
def test_increments_give_what_one_run_gives(spark, store, seed):
    rows = keyed_rows(spark, seed)
    for part in range(4):
        merge(store.at("t"), rows.where(F.pmod(F.xxhash64("_seq"), F.lit(4)) == part), ["k", "j"], buckets=4)
    assert listed(state(store.at("t")).select(rows.columns)) == listed(keep_first(rows, ["k", "j"]))


def test_the_last_of_each_key(spark, store):
    rows = keyed_rows(spark)
    for part in (1, 0):
        merge(store.at("t"), rows.where(f"_seq % 2 = {part}"), ["k"], latest=True, buckets=4)
    last = rows.groupBy("k").agg(F.max("_seq").alias("_seq"))
    assert listed(state(store.at("t")).select("k", "_seq")) == listed(last)


def test_only_parts_that_change_are_written(spark, store):
    rows = spark.range(200).select(F.col("id").alias("_seq"), F.col("id").alias("k"))
    assert merge(store.at("t"), rows, ["k"], buckets=16) == {"changed": 200, "parts": 16}
    before = {p["key"]: p["path"] for p in store.parts("t")}
    assert merge(store.at("t"), rows.withColumn("_seq", F.col("_seq") + 1000), ["k"], buckets=16) == {"changed": 0, "parts": 0}
    one = spark.createDataFrame([(-1, 7)], "_seq long, k long")
    assert merge(store.at("t"), one, ["k"], buckets=16) == {"changed": 1, "parts": 1}
    after = {p["key"]: p["path"] for p in store.parts("t")}
    assert sum(before[k] != after[k] for k in before) == 1 and state(store.at("t")).count() == 200


def test_a_batch_merges_once_and_a_lost_race_fails(spark, store, monkeypatch):
    rows = keyed_rows(spark)
    assert merge(store.at("t"), rows, ["k"], batch=("b", 1), buckets=4)["changed"] == 10
    assert merge(store.at("t"), rows, ["k"], batch=("b", 1), buckets=4) == {"changed": 0, "parts": 0}
    real = snapshots.Load.replace

    def raced(self, *args, **more):
        monkeypatch.undo()
        store.begin().append("other", spark.range(1)).commit()
        return real(self, *args, **more)

    monkeypatch.setattr(snapshots.Load, "replace", raced)
    with pytest.raises(Conflict):
        merge(store.at("t"), rows.withColumn("_seq", F.col("_seq") - 1000), ["k"], buckets=4)
    assert listed(state(store.at("t")).select("_seq")) == listed(keep_first(rows, ["k"]).select("_seq"))


def test_empty_increments(spark, store):
    rows = keyed_rows(spark)
    assert merge(store.at("t"), rows.where("false"), ["k"], buckets=4)["changed"] == 0
    merge(store.at("t"), rows, ["k"], buckets=4)
    assert merge(store.at("t"), rows.where("false"), ["k"], buckets=4)["changed"] == 0
    assert state(store.at("t")).count() == 10


def records(spark, *rows):
    return spark.createDataFrame(rows, "id long, write_date string, state string, _seq long")


def test_mirror_follows_changes_and_late_records(spark, store):
    target = store.at("m")
    mirror(target, records(spark, (1, "2024-01-01 08:00:00", "a", 1), (2, "2024-01-03 08:00:00", "a", 2), (3, None, "a", 3)), buckets=4)
    assert store.mark("m.write_date") == "2024-01-03 08:00:00"
    source = records(spark, (1, "2024-01-09 08:00:00", "b", 1), (2, "2024-01-03 08:00:00", "a", 2), (4, "2024-01-02 07:00:00", "late", 4),
                     (5, "2023-12-01 07:00:00", "too late", 5), (3, "2024-01-02 00:00:00", "b", 3))
    mirror(target, source, buckets=4)
    want = [(1, "b"), (2, "a"), (3, "b"), (4, "late")]
    assert listed(state(target).select("id", "state")) == want and store.mark("m.write_date") == "2024-01-09 08:00:00"
    assert mirror(target, source, buckets=4) == {"changed": 0, "parts": 0}
    mirror(target, records(spark, (1, "2024-01-08 00:00:00", "older", 9)), buckets=4)
    assert listed(state(target).select("id", "state")) == want


def test_the_mark_reaches_the_scan(spark, tmp_path):
    path = f"{tmp_path}/raw"
    records(spark, (1, "2024-01-01", "a", 1)).write.parquet(path)
    plan = changed_since(spark.read.parquet(path), "write_date", "2024-01-03 08:00:00", 2)._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(write_date,2024-01-01)" in plan


def invoice_tables(spark):
    moves = [dict(id=i, _seq=i, state="posted", move_type="out_invoice", invoice_date=f"2024-{1 + i % 4:02d}-{1 + i:02d}",
                  partner_id='[7, "C"]', name=f"F{i}") for i in range(12)]
    moves.append(dict(moves[1], _seq=50, invoice_date="2024-03-20", name="later"))
    lines = [dict(id=10 * i, _seq=i, display_type="product", date=m["invoice_date"], move_id=f'[{m["id"]}, "F"]', product_id='[3, "P"]',
                  price_subtotal=5.0 + i, quantity=1.0) for i, m in enumerate(moves)]
    return (spark.createDataFrame([json.dumps(m) for m in moves], "string").select(F.from_json("value", schemas.RAW_INVOICES).alias("r")).select("r.*"),
            spark.createDataFrame([json.dumps(x) for x in lines], "string").select(F.from_json("value", schemas.RAW_INVOICE_LINES).alias("r")).select("r.*"))


def test_close_shows_both_tables_or_neither(spark, store, monkeypatch):
    moves, lines = invoice_tables(spark)
    real, calls = snapshots.Load._write, []

    def second_fails(self, name, *args):
        calls.append(name)
        if len(calls) == 2:
            raise OSError("executor lost")
        return real(self, name, *args)

    monkeypatch.setattr(snapshots.Load, "_write", second_fails)
    with pytest.raises(OSError):
        inc.close_month(store, moves, lines, "2024-03-01")
    assert calls == [inc.HEAD_HISTORY, inc.LINE_HISTORY] and store.version() == 0
    monkeypatch.undo()
    for _ in range(2):
        assert inc.close_month(store, moves, lines, "2024-03-01")
    heads, own = store.table(inc.HEAD_HISTORY), store.table(inc.LINE_HISTORY)
    assert {str(r[0]) for r in heads.select("mes").collect()} == {"2024-02-01"} == {str(r[0]) for r in own.select("mes").collect()}
    assert heads.count() == jobs.closed_month_invoices_plan(moves, "2024-03-01").count()


def test_a_backfill_goes_on_where_it_stopped(spark, store, monkeypatch):
    moves, lines = invoice_tables(spark)
    real, calls = snapshots.Load.commit, []

    def third_fails(self):
        calls.append(1)
        if len(calls) == 3:
            raise OSError("killed")
        return real(self)

    monkeypatch.setattr(snapshots.Load, "commit", third_fails)
    with pytest.raises(OSError):
        inc.resume_backfill(store, moves, lines, "2024-06-15", "2024-01-01", months_per_commit=1)
    monkeypatch.undo()
    assert {p["key"] for p in store.parts(inc.HEAD_HISTORY)} == {"2024-01-01", "2024-02-01"}
    assert inc.resume_backfill(store, moves, lines, "2024-06-15", "2024-01-01", 2) == ["2024-03-01", "2024-04-01", "2024-05-01"]
    assert inc.resume_backfill(store, moves, lines, "2024-06-15", "2024-01-01", 2) == []  # May is known to be empty
    want = jobs.backfill_invoices_plan(moves, "2024-06-15", "2024-01-01")
    assert listed(store.table(inc.HEAD_HISTORY).drop("mes")) == listed(want)
    assert store.table(inc.LINE_HISTORY).count() == jobs.backfill_invoice_lines_plan(lines, moves, "2024-06-15", "2024-01-01").count()
    part = next(p for p in store.parts(inc.LINE_HISTORY) if p["key"] == "2024-02-01")
    rows = spark.read.parquet(f"{store.path}/{part['path']}").collect()
    spark.createDataFrame(rows[:-1], store.table(inc.LINE_HISTORY).schema).write.mode("overwrite").parquet(f"{store.path}/{part['path']}")
    assert inc.resume_backfill(store, moves, lines, "2024-06-15", "2024-01-01") == ["2024-02-01"]
    assert listed(store.table(inc.HEAD_HISTORY).drop("mes")) == listed(want)
    assert store.table(inc.LINE_HISTORY).count() == jobs.backfill_invoice_lines_plan(lines, moves, "2024-06-15", "2024-01-01").count()


def test_invoices_by_increments(spark, store):
    moves, _ = invoice_tables(spark)
    for part in (2, 0, 1):
        inc.add_invoices(store, moves.where(f"_seq % 3 = {part}"), start="2024-01-01", buckets=4)
    assert listed(inc.invoices(store)) == listed(tf.invoices(invoices_raw(moves, start="2024-01-01")))


def test_orders_and_lines_by_mirror(spark, store):
    order = lambda **x: json.dumps({"date_order": "2024-03-05 10:00:00", "create_date": "2024-03-05 10:00:00", "user_id": '[1, "S"]', **x})
    line = lambda **x: json.dumps({"create_date": "2024-03-05 10:00:00", "order_id": '[1, "S"]', "product_uom_qty": 1.0, **x})
    read = lambda texts, schema: spark.createDataFrame(texts, "string").select(
        F.from_json("value", schema.add("write_date", "string")).alias("r")).select("r.*")
    heads = lambda *rows: read(list(rows), type(schemas.RAW_ORDERS)(schemas.RAW_ORDERS.fields[:]))
    lines = lambda *rows: read(list(rows), type(schemas.RAW_ORDER_LINES)(schemas.RAW_ORDER_LINES.fields[:]))
    inc.mirror_orders(store, heads(order(id=1, _seq=1, state="draft", write_date="2024-03-05"), order(id=2, _seq=2, write_date="2024-03-05")),
                      lines(line(id=10, _seq=1, price_unit=1.0, write_date="2024-03-05")))
    inc.mirror_orders(store, heads(order(id=1, _seq=1, state="sale", write_date="2024-03-07")),
                      lines(line(id=10, _seq=1, price_unit=2.0, write_date="2024-03-06"), line(id=11, _seq=2, price_unit=3.0, write_date="2024-03-06")))
    assert listed(inc.mirrored_orders(store, "2024-03-10").select("id_pedido", "estado_pedido")) == [(1, "sale"), (2, "")]
    assert listed(inc.mirrored_order_lines(store, "2024-03-10").select("id_linea", "precio_unitario")) == [(10, 2.0), (11, 3.0)]


def test_landings_are_appended_once(spark, store, tmp_path, monkeypatch):
    landing, name = tmp_path / "landing", f"moves-{uuid.uuid4().hex}"
    landing.mkdir()
    record = lambda **x: json.dumps(dict(state="posted", move_type="out_invoice", invoice_date="2024-03-02", partner_id='[7, "C"]', **x))
    run = lambda: append_new_landings(spark, str(landing), schemas.RAW_INVOICES, store.at("t"), name, lambda df: df.select("id"))
    (landing / "a.json").write_text(record(id=1, _seq=1) + "\n" + record(id=2, _seq=2))
    assert run() == [0] and run() == []
    (landing / "b.json").write_text(record(id=3, _seq=3))
    real = snapshots.Load.commit

    def commits_then_fails(self):  # the rows are published, the stream does not hear of it
        real(self)
        raise OSError("driver lost")

    monkeypatch.setattr(snapshots.Load, "commit", commits_then_fails)
    with pytest.raises(Exception, match="driver lost"):
        run()
    monkeypatch.undo()
    assert run() == [1]
    assert listed(store.table("t")) == [(1,), (2,), (3,)]

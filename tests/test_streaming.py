"""Change-detection trigger: each landed file is seen once across runs."""

import json
import uuid

from ledgerspark import schemas
from ledgerspark.plans import jobs
from ledgerspark.streaming import run_on_new_landings


def _land(path, name, records):
    (path / name).write_text("\n".join(json.dumps(r) for r in records))


def test_refresh_runs_only_for_new_files(spark, tmp_path):
    landing = tmp_path / "moves"
    landing.mkdir()
    current = str(tmp_path / "current")
    name = f"moves-{uuid.uuid4().hex}"
    seen = []

    def refresh(new_rows, batch_id):
        seen.append(new_rows.count())
        # the job re-reads the whole landing: keep-first needs every row
        all_moves = spark.read.schema(schemas.RAW_INVOICES).json(str(landing))
        jobs.sync_invoices(all_moves, str(tmp_path / "hist"), current, "2024-03-15")

    rec = dict(state="posted", move_type="out_invoice", invoice_date="2024-03-02",
               partner_id='[7, "C"]')
    _land(landing, "p1.json", [dict(rec, id=1, _seq=1), dict(rec, id=2, _seq=2)])
    assert run_on_new_landings(spark, str(landing), schemas.RAW_INVOICES, refresh, name) == [0]
    assert run_on_new_landings(spark, str(landing), schemas.RAW_INVOICES, refresh, name) == []
    _land(landing, "p2.json", [dict(rec, id=3, _seq=3)])
    assert len(run_on_new_landings(spark, str(landing), schemas.RAW_INVOICES, refresh, name)) == 1
    assert seen == [2, 1]
    assert sorted(r.id_factura for r in spark.read.parquet(current).collect()) == [1, 2, 3]

"""Envelope parsing by hand-written records, and streaming behaviour."""

from __future__ import annotations

import datetime as dt
import json
from decimal import Decimal as D

from pyspark.sql import functions as F

from tidemark.operators.dedup import latest_event_per_key
from tidemark.operators.merge import live_rows
from tidemark.session import fresh_path
from tidemark.sinks import fact_table
from tidemark.streaming import envelope, monitor, pipeline

NOW = dt.datetime(2024, 2, 1)


def image(sale_id=1, **fields):
    row = {"sale_id": sale_id, "customer_id": "C1", "product_id": "P1", "sale_date": "2024-01-05", "quantity": 2, "unit_price": 10.5,
           "total_amount": 21.0, "store_id": "S1", "payment_method": "cash", "discount_amount": None, "tax_amount": 1.25,
           "created_at": 1704067200000, "updated_at": "2024-01-05 10:00:00", "is_deleted": False, "status": "completed"}
    return {**row, **fields}


def record(op, after=None, before=None, ts=1704449000123, region="us_east"):
    return json.dumps({"before": before, "after": after, "op": op, "ts_ms": ts, "region": region})


def raw(spark, records, start=0):
    rows = [(text, "t", 0, start + i, NOW) for i, text in enumerate(records)]
    return spark.createDataFrame(rows, "record_content string, _kafka_topic string, _kafka_partition int, _kafka_offset long, _kafka_timestamp timestamp_ntz")


def test_envelopes(spark):
    records = [
        record("c", image(1)),
        record("u", image(2, is_deleted=None, region="europe"), {"sale_id": 2}),
        record("d", None, {"sale_id": 3, "updated_at": 1704449000000}),
        record("r", image(4, status="pending")),
        None,
        '{"op": "c", "after": {"sale_id": 5',
        record("c", image("six")),
        record("c", {"customer_id": "C"}),
        record("x", image(8)),
        record("u", image(9, is_deleted=True)),
    ]
    parsed = {r.sale_id: r for r in envelope.parse_envelopes(raw(spark, records), NOW).collect()}
    assert sorted(parsed) == [1, 2, 3, 9]
    one = parsed[1]
    assert (one.total_amount, one.net_amount, one.gross_profit) == (D("21.00"), D("21.00"), D("19.75"))
    assert (one.created_at, one.updated_at) == (dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 5, 10))
    assert one._cdc_source_ts == dt.datetime(2024, 1, 5, 10, 3, 20, 123000)
    assert [parsed[i].is_deleted for i in (1, 2, 3, 9)] == [False, False, True, True]
    assert [parsed[i].region for i in (1, 2, 3)] == ["US-EAST", "EUROPE", "US-EAST"]
    assert parsed[3].updated_at == dt.datetime(2024, 1, 5, 10, 3, 20)
    assert parsed[3].sale_date is None and parsed[3].sale_year is None
    assert envelope.parse_envelopes(raw(spark, records), NOW, completed_only=False).count() == 5
    rejected = {r._kafka_offset: r.rejection_reason for r in envelope.dead_letters(raw(spark, records)).collect()}
    assert rejected == {5: "unreadable", 6: "unreadable", 7: "no_key", 8: "unknown_operation"}


def test_values_that_do_not_fit_are_diverted(spark):
    records = [
        record("c", image(1, total_amount=1e9)),
        record("c", image(2, total_amount=-99999999.99, discount_amount=99999999.99)),
        record("u", image(3, updated_at="999999999999999999")),
        record("u", image(4), ts=999999999999999999),
        record("u", image(5, sale_date="soon")),
        record("d", None, {"sale_id": 6, "updated_at": "never"}),
        record("c", image(7)),
    ]
    assert [r.sale_id for r in envelope.parse_envelopes(raw(spark, records), NOW).collect()] == [7]
    rejected = [r.rejection_reason for r in envelope.dead_letters(raw(spark, records)).orderBy("_kafka_offset").collect()]
    assert rejected == ["bad_amount"] * 2 + ["bad_timestamp"] * 4


def test_renewed_checkpoint_merges_and_audits_anew(spark):
    staged, fact, audit = (fresh_path(spark, name) for name in ("staged", "fact", "audit"))
    rows = envelope.parse_envelopes(raw(spark, [record("c", image(1)), record("c", image(2))]), NOW)
    rows.filter("sale_id = 1").write.parquet(staged)
    pipeline.merge_stream(spark, staged, fact, audit, fresh_path(spark, "c"), NOW).awaitTermination()
    rows.filter("sale_id = 2").write.mode("append").parquet(staged)
    pipeline.merge_stream(spark, staged, fact, audit, fresh_path(spark, "c"), NOW).awaitTermination()
    assert {r.sale_id for r in fact_table.read_fact(spark, fact).collect()} == {1, 2}
    assert sorted((r.merge_id, r.rows_inserted) for r in spark.read.parquet(audit).collect()) == [(0, 1), (0, 1)]


def test_record_is_parsed_once(spark):
    plan = envelope.parse_envelopes(raw(spark, [record("c", image())]), NOW)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json") == 1


def test_region_stamp_and_routing(spark):
    stamped = envelope.stamp_region(raw(spark, ['{"op": "c", "after": {"sale_id": 1}}']), "europe")
    routed = envelope.route_topic(stamped, "^t$", "sales").select("_kafka_topic", F.get_json_object("record_content", "$.region")).first()
    assert tuple(routed) == ("sales", "europe")


def test_delete_and_older_update_in_one_batch(spark):
    records = [record("d", None, {"sale_id": 1}, ts=2000), record("u", image(1), ts=1000)]
    rows = latest_event_per_key(envelope.parse_envelopes(raw(spark, records), NOW)).collect()
    assert [r.is_deleted for r in rows] == [True]


def test_only_new_data_runs_and_late_events_do_not_revive(spark):
    paths = {name: fresh_path(spark, name) for name in ("landing", "staged", "fact", "audit", "c1", "c2")}

    def run():
        landed = pipeline.landed_stream(spark, paths["landing"])
        parsing = pipeline.parse_stream(landed, paths["staged"], paths["c1"], NOW)
        parsing.awaitTermination()
        merging = pipeline.merge_stream(spark, paths["staged"], paths["fact"], paths["audit"], paths["c2"], NOW)
        merging.awaitTermination()
        return monitor.progress(merging)

    pipeline.land(raw(spark, [record("c", image(1), ts=1000), record("c", image(2), ts=1000)]), paths["landing"], NOW)
    assert run()["has_data"]
    pipeline.land(raw(spark, [record("d", None, {"sale_id": 1}, ts=5000)], 10), paths["landing"], NOW)
    run()
    assert not run()["has_data"]
    pipeline.land(raw(spark, [record("u", image(1), ts=3000), record("u", image(2, quantity=9), ts=500)], 20), paths["landing"], NOW)
    run()
    table = live_rows(fact_table.read_fact(spark, paths["fact"], fact_table.TOMBSTONE_FACT_COLUMNS))
    assert {r.sale_id: r.quantity for r in table.collect()} == {2: 2}
    audit = spark.read.parquet(paths["audit"]).orderBy("merge_id").collect()
    assert [(r.rows_inserted, r.rows_updated, r.rows_deleted, r.min_kafka_offset, r.max_kafka_offset) for r in audit] == [
        (2, 0, 0, 0, 1), (0, 0, 1, 10, 10), (0, 0, 0, 20, 21)]


def test_late_rows_are_dropped_and_counted(spark):
    landing, path, checkpoint = (fresh_path(spark, name) for name in ("landing", "distinct", "c"))
    hours = [(0, 0), (1, 100), (1, 100), (2, 99), (3, 98)]
    rows = [("{}", "t", 0, offset, NOW + dt.timedelta(hours=h)) for offset, h in hours]
    ddl = "record_content string, _kafka_topic string, _kafka_partition int, _kafka_offset long, _kafka_timestamp timestamp_ntz"
    first = spark.createDataFrame(rows, ddl)
    assert monitor.redelivery_delay(first) == "86400 seconds"
    again = spark.createDataFrame([*rows, ("{}", "t", 0, 1, NOW + dt.timedelta(hours=130))], ddl)
    assert monitor.redelivery_delay(again) == f"{30 * 3600 + 1} seconds"
    late = []
    for records in (first, spark.createDataFrame([("{}", "t", 0, 4, NOW + dt.timedelta(hours=75)), ("{}", "t", 0, 5, NOW + dt.timedelta(hours=77))], ddl)):
        pipeline.land(records, landing, NOW)
        kept = pipeline.without_redelivered(pipeline.landed_stream(spark, landing), "86400 seconds").select("_kafka_offset")
        query = pipeline.start(kept.writeStream.format("parquet").option("path", path), checkpoint)
        query.awaitTermination()
        late.append(monitor.late_rows(query))
    assert late == [0, 1]
    assert sorted(r[0] for r in spark.read.schema("_kafka_offset long").parquet(path).collect()) == [0, 1, 2, 3, 5]


def test_merge_that_runs_again_keeps_its_audit_row(spark, monkeypatch):
    staged, fact, audit, checkpoint = (fresh_path(spark, name) for name in ("staged", "fact", "audit", "c"))
    envelope.parse_envelopes(raw(spark, [record("c", image(1)), record("c", image(2))]), NOW).write.parquet(staged)
    with monkeypatch.context() as patch:
        patch.setattr(pipeline, "replace_slices", lambda *args: 1 / 0)  # dies after the merge, before its audit row
        try:
            pipeline.merge_stream(spark, staged, fact, audit, checkpoint, NOW).awaitTermination()
        except Exception:  # noqa: BLE001
            pass
    assert not fact_table.exists(spark, audit)
    pipeline.merge_stream(spark, staged, fact, audit, checkpoint, NOW).awaitTermination()
    rows = spark.read.parquet(audit).collect()
    assert [(r.rows_inserted, r.events, r.min_kafka_offset, r.max_kafka_offset) for r in rows] == [(2, 2, 0, 1)]

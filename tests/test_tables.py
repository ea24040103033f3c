"""Stored tables: merges on parquet, replays, files, the daily batch."""

from __future__ import annotations

import datetime as dt
import json
import re
from decimal import Decimal as D
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from tests.conftest import SF_TINY
from tidemark.operators import aggregates, dedup, merge, snapshot
from tidemark.plans import daily_batch, inputs
from tidemark.schemas import FACT_COLUMNS, STAGE_COLUMNS, conform, schema_of
from tidemark.session import fresh_path, written
from tidemark.sinks import fact_table, partitions
from tidemark.sources import files
from tidemark.sources.tables import REGIONS

NOW = dt.datetime(2024, 6, 1)


def staged(spark, rows):
    """Rows (sale_id, day, total, deleted, source time, offset)."""
    df = spark.createDataFrame(
        [(i, d, D(t) if t else None, x, s, o) for i, d, t, x, s, o in rows],
        "sale_id long, sale_date timestamp_ntz, total_amount decimal(10,2), is_deleted boolean, "
        "_cdc_source_ts timestamp_ntz, _kafka_offset long",
    )
    parts = {"sale_year": F.year("sale_date"), "sale_month": F.month("sale_date"), "updated_at": F.col("_cdc_source_ts")}
    return conform(df.withColumns(parts), STAGE_COLUMNS)


def day(month, number):
    return dt.datetime(2024, month, number)


def state(df):
    return {r.sale_id: (r.sale_month, r.total_amount) for r in df.collect()}


def test_merge_moves_and_empties_partitions(spark):
    path = fresh_path(spark, "t")
    first = staged(spark, [(1, day(1, 1), "1", False, day(1, 1), 1), (2, day(2, 1), "2", False, day(2, 1), 2), (3, day(3, 1), "3", False, day(3, 1), 3)])
    fact_table.merge_into_fact(spark, path, first, NOW, "a")
    second = staged(spark, [(1, day(3, 5), "9", False, day(4, 1), 4), (2, None, None, True, day(4, 1), 5), (8, None, None, True, day(4, 1), 6), (4, day(5, 1), "4", False, day(4, 1), 7)])
    tally = fact_table.merge_into_fact(spark, path, second, NOW, "b")
    assert tuple(tally.first()) == (1, 1, 1)
    assert state(fact_table.read_fact(spark, path)) == {1: (3, D("9.00")), 3: (3, D("3.00")), 4: (5, D("4.00"))}
    fact_table.merge_into_fact(spark, path, second, NOW, "b")
    assert state(fact_table.read_fact(spark, path)) == {1: (3, D("9.00")), 3: (3, D("3.00")), 4: (5, D("4.00"))}


def sale(spark, sale_id, total, time=1):
    return staged(spark, [(sale_id, day(1, 1), total, False, day(1, time), time)])


def test_interrupted_merge_is_finished_by_the_next(spark, monkeypatch):
    path = fresh_path(spark, "t")
    fact_table.merge_into_fact(spark, path, sale(spark, 1, "1"), NOW, "a")
    publish = fact_table._publish
    with monkeypatch.context() as patch:
        patch.setattr(fact_table, "_publish", lambda *args: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            fact_table.merge_into_fact(spark, path, sale(spark, 1, "5"), NOW, "b")
    assert fact_table._publish is publish
    fact_table._drop_folder(spark, f"{path}/sale_year=2024/sale_month=1")  # as half a publication leaves it
    fact_table.merge_into_fact(spark, path, sale(spark, 2, "2"), NOW, "c")
    assert state(fact_table.read_fact(spark, path)) == {1: (1, D("5.00")), 2: (1, D("2.00"))}


def test_replayed_batch_keeps_later_batches(spark):
    path = fresh_path(spark, "t")
    for sale_id, total, run_id in ((1, "1", "day1"), (2, "2", "day2"), (1, "99", "day1")):
        fact_table.merge_into_fact(spark, path, sale(spark, sale_id, total), NOW, run_id)
    assert state(fact_table.read_fact(spark, path)) == {1: (1, D("99.00")), 2: (1, D("2.00"))}


def test_run_merged_once_keeps_its_tally(spark):
    path = fresh_path(spark, "t")
    for _ in range(2):
        tally = fact_table.merge_into_fact(spark, path, sale(spark, 1, "1"), NOW, "q-0", newest_only=True, once=True)
        assert tuple(tally.first()) == (1, 0, 0)


def test_merge_prunes_months_by_the_touched_ones(spark):
    path = fresh_path(spark, "t")
    fact_table.merge_into_fact(spark, path, sale(spark, 1, "1"), NOW, "a")
    months = written(sale(spark, 1, "1").select(*fact_table.PARTITION_BY), "months")
    plan = fact_table.in_cells(fact_table.read_fact(spark, path), months)
    assert "dynamicpruning" in plan._jdf.queryExecution().executedPlan().toString()


def rows_of(daily):
    return sorted(map(str, daily.drop("_aggregated_at").collect()))


def files_of(spark, path):
    """Data files of a table below ``path`` by name."""
    root = path.removeprefix("file:")
    return {str(f.relative_to(root)): f.stat().st_mtime_ns for f in Path(root).rglob("*.parquet")}


def many(spark, ids, month=1, total="1", time=1):
    return staged(spark, [(i, day(month, 1 + i % 20), total, False, day(1, time), i) for i in ids])


def test_small_merge_rewrites_its_buckets_only(spark):
    path = fresh_path(spark, "t")
    first = many(spark, range(400), 1).unionByName(many(spark, range(400, 800), 2))
    fact_table.merge_into_fact(spark, path, first, NOW, "a", buckets=16)
    before = files_of(spark, path)
    fact_table.merge_into_fact(spark, path, many(spark, [7], 1, "9", 2), NOW, "b", buckets=3)  # a table keeps its own number
    after = files_of(spark, path)
    assert fact_table.table_buckets(spark, path) == 16
    gone = {name.rsplit("/", 1)[0] for name in before if after.get(name) != before[name]}
    assert len(gone) == 1 and gone.pop().startswith("sale_year=2024/sale_month=1/key_bucket=")
    got = state(fact_table.read_fact(spark, path))
    assert len(got) == 800 and got[7] == (1, D("9.00")) and got[407] == (2, D("1.00"))


def test_search_for_changed_keys_skips_other_buckets(spark):
    path = fresh_path(spark, "t")
    fact_table.merge_into_fact(spark, path, many(spark, range(400)), NOW, "a", buckets=16)
    stored = spark.read.schema("sale_id long, sale_year int, sale_month int, key_bucket int").parquet(path)
    changes = written(fact_table.with_bucket(many(spark, [3], 1), 16), "changes")
    found = fact_table.touched_cells(stored, changes, 16)
    assert found.count() == 1
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "dynamicpruning" in plan and "ReadSchema: struct<sale_id:bigint>" in plan


def test_bucketed_stream_moves_and_empties(spark):
    path = fresh_path(spark, "t")
    for i, change in enumerate(EVENTS):
        fact_table.merge_into_fact(spark, path, staged(spark, [change]), NOW, str(i), newest_only=True, buckets=3, daily=True)
    table = fact_table.read_fact(spark, path, fact_table.TOMBSTONE_FACT_COLUMNS)
    live = merge.live_rows(table)
    assert state(live) == {1: (1, D("2.00")), 3: (2, D("6.00"))}
    assert rows_of(fact_table.read_daily(spark, path)) == rows_of(aggregates.daily_sales(live.select(*FACT_COLUMNS), NOW))


def test_kept_tables_follow_interrupted_merges(spark, monkeypatch):
    path = fresh_path(spark, "t")
    fact_table.merge_into_fact(spark, path, many(spark, range(20)), NOW, "a")
    keep = {"daily": True, "history": True}
    fact_table.merge_into_fact(spark, path, many(spark, [1, 2, 30], 2, "5", 3), NOW, "b", **keep)
    with monkeypatch.context() as patch:
        patch.setattr(fact_table, "_publish", lambda *args: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            fact_table.merge_into_fact(spark, path, staged(spark, [(1, None, None, True, day(4, 1), 9), (2, day(3, 1), "7", False, day(4, 1), 9)]), NOW, "c", **keep)
    with pytest.raises(ValueError):
        fact_table.merge_into_fact(spark, path, many(spark, [3]), NOW, "d")
    fact_table.merge_into_fact(spark, path, many(spark, [31, 1], 4, "2", 5), NOW, "e", **keep)
    fact = fact_table.read_fact(spark, path)
    assert state(fact)[2] == (3, D("7.00")) and state(fact)[1] == (4, D("2.00"))
    assert rows_of(fact_table.read_daily(spark, path)) == rows_of(aggregates.daily_sales(fact, NOW))
    history = fact_table.read_history(spark, path)
    open_ones = history.filter("dbt_valid_to IS NULL")
    assert {(r.sale_id, r.updated_at) for r in open_ones.collect()} == {(r.sale_id, r.updated_at) for r in fact.collect()}
    versions = [(r.updated_at, r.dbt_valid_to) for r in history.filter("sale_id = 1").orderBy("dbt_valid_from").collect()]
    assert versions == [(day(1, 1), day(1, 3)), (day(1, 3), NOW), (day(1, 5), None)]


def test_history_gets_changed_keys_only(spark):
    path = fresh_path(spark, "t")
    for run_id in ("a", "b"):
        fact_table.merge_into_fact(spark, path, many(spark, range(50)), NOW, run_id, history=True)
    assert fact_table.read_history(spark, path).count() == 50
    before = files_of(spark, f"{path}__history")
    fact_table.merge_into_fact(spark, path, many(spark, [4], 1, "2", 7), NOW, "c", history=True)
    after = files_of(spark, f"{path}__history")
    assert all(after[name] == stamp for name, stamp in before.items())
    opened, closed = fact_table._log(spark, path)
    assert opened.filter("run LIKE 'c--%'").count() == closed.filter("run LIKE 'c--%'").count() == 1


def test_kept_tables_read_changed_rows_only(spark):
    path = fresh_path(spark, "t")
    fact_table.merge_into_fact(spark, path, many(spark, range(50)), NOW, "a", daily=True)
    fact_table.merge_into_fact(spark, path, many(spark, [4], 1, "2", 7), NOW, "b", daily=True)
    runs = fact_table._attempts(spark, f"{fact_table.shared_dir(spark)}/tidemark/merge/{fact_table.hashlib.md5(path.encode()).hexdigest()}")
    staged_rows = fact_table._staged(spark, runs[0], schema_of(FACT_COLUMNS))
    images = merge.signed_images(staged_rows.filter("_changed"), ["sale_id", "total_amount"])
    assert sorted((r._sign, r.sale_id, r.total_amount) for r in images.collect()) == [(-1, 4, D("1.00")), (1, 4, D("2.00"))]
    plan = images._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[isnotnull\(_changed#\d+\), _changed#\d+\]", plan)


def test_failures_of_other_runs_stay_and_empty_reruns_clear(spark):
    path = fresh_path(spark, "f")
    rows = spark.createDataFrame([("bad", 1), ("worse", 2)], "validation_failure_reason string, v int")
    partitions.write_failures(rows, path, "1")
    partitions.write_failures(rows, path, "2")
    partitions.write_failures(rows.filter("v = 2"), path, "1")
    left = {(r.run_id, r.v) for r in spark.read.parquet(path).collect()}
    assert left == {(1, 2), (2, 1), (2, 2)}
    partitions.write_failures(rows.filter("v = 3"), path, "2")
    assert {(r.run_id, r.v) for r in spark.read.parquet(path).collect()} == {(1, 2)}


EVENTS = [
    (1, day(1, 1), "1", False, day(1, 1), 1),
    (1, day(1, 2), "2", False, day(1, 3), 3),
    (1, day(1, 2), "7", False, day(1, 2), 9),
    (2, day(1, 1), "4", False, day(1, 1), 2),
    (2, None, None, True, day(1, 5), 4),
    (2, day(1, 1), "5", False, day(1, 4), 8),
    (3, None, None, True, day(1, 1), 5),
    (3, day(2, 1), "6", False, day(1, 6), 6),
    (4, None, None, True, day(1, 9), 7),
]


@pytest.mark.parametrize("cuts", [[9], [1, 3, 5], [2, 4, 6, 8], [5]])
@pytest.mark.parametrize("backwards", [False, True])
def test_any_split_of_a_stream_gives_the_same_table(spark, cuts, backwards):
    events = EVENTS[::-1] if backwards else EVENTS
    path = fresh_path(spark, "t")
    edges = [0, *[c for c in cuts if c < len(events)], len(events)]
    for i, (low, high) in enumerate(zip(edges, edges[1:])):
        change = dedup.latest_event_per_key(staged(spark, events[low:high]))
        fact_table.merge_into_fact(spark, path, change, NOW, str(i), newest_only=True)
    table = fact_table.read_fact(spark, path, fact_table.TOMBSTONE_FACT_COLUMNS)
    assert state(merge.live_rows(table)) == {1: (1, D("2.00")), 3: (2, D("6.00"))}


def test_merge_twice_is_merge_once(spark):
    old, changes = inputs.old_fact(spark, SF_TINY), inputs.changes(spark, SF_TINY)
    once = merge.cdc_merge(old, changes, inputs.AS_OF)
    twice = merge.cdc_merge(once, changes, inputs.AS_OF)
    assert once.exceptAll(twice).count() == 0 and twice.exceptAll(once).count() == 0


def test_validity_intervals_do_not_overlap(spark):
    old = inputs.old_fact(spark, SF_TINY)
    new = merge.cdc_merge(old, inputs.changes(spark, SF_TINY), inputs.AS_OF)
    history = snapshot.take_snapshot(snapshot.first_snapshot(old), new, inputs.AS_OF)
    a, b = history.alias("a"), history.alias("b")
    clash = a.join(b, "sale_id").filter(
        (F.col("a.dbt_scd_id") != F.col("b.dbt_scd_id"))
        & (F.col("a.dbt_valid_from") < F.coalesce("b.dbt_valid_to", F.lit(dt.datetime(2999, 1, 1))))
        & (F.col("b.dbt_valid_from") < F.coalesce("a.dbt_valid_to", F.lit(dt.datetime(2999, 1, 1))))
    )
    assert clash.count() == 0
    assert history.filter("dbt_valid_to is null").count() == new.count()


def test_passed_and_quarantined_make_the_whole(spark):
    from tidemark.operators import enrich

    checked = inputs.checked(inputs.sales(spark, SF_TINY))
    assert enrich.passed(checked).count() + enrich.quarantined(checked).count() == checked.count()


def test_stage_csv_null_tokens_and_bad_values(spark, tmp_path):
    good = tmp_path / "good.csv"
    good.write_text('1,NULL,"a,b"\n2,null,\n3,2024-01-02 03:04:05.000006,"say ""hi"""\n')
    schema = schema_of(["sale_id", "sale_date", "region"])
    rows = {r.sale_id: (r.sale_date, r.region) for r in files.read_stage_csv(spark, str(good), schema).collect()}
    assert rows == {1: (None, "a,b"), 2: (None, None), 3: (dt.datetime(2024, 1, 2, 3, 4, 5, 6), 'say "hi"')}
    bad = tmp_path / "bad.csv"
    bad.write_text("x,NULL,a\n")
    with pytest.raises(Exception):
        files.read_stage_csv(spark, str(bad), schema).collect()


def test_region_config_and_seed(spark, tmp_path):
    config = tmp_path / "regions.json"
    config.write_text(json.dumps({"regions": [{"name": "us_east", "display_name": "US-EAST", "retries": 3}]}, indent=2))
    regions = files.read_region_config(spark, str(config))
    df = spark.createDataFrame([(1, "us_east"), (2, "moon")], "id int, region string")
    assert dict(files.with_region_names(df, regions).collect()) == {1: "US-EAST", 2: None}
    seed = tmp_path / "methods.csv"
    seed.write_text("payment_method,display_name,is_digital\ncash,Cash,false\n")
    assert files.read_seed(spark, str(seed)).first() == ("cash", "Cash", False)


def test_replaced_slices_leave_others_alone(spark):
    path = fresh_path(spark, "s")
    df = spark.createDataFrame([("a", 1), ("b", 2)], "k string, v int")
    partitions.replace_slices(df, path, ["k"])
    partitions.replace_slices(spark.createDataFrame([("a", 5)], "k string, v int"), path, ["k"])
    assert {(r.k, r.v) for r in spark.read.parquet(path).collect()} == {("a", 5), ("b", 2)}


def test_daily_batch(spark):
    warehouse = daily_batch.Warehouse(fresh_path(spark, "warehouse"))
    labels = {r.lower().replace(" ", "_"): r for r in REGIONS}
    rows = inputs.sales(spark, SF_TINY).withColumn("status", F.lit("completed"))
    rows = rows.withColumn("updated_at", F.when(F.year("updated_at") < 1998, F.lit(dt.datetime(2001, 9, 1))).otherwise(F.lit(dt.datetime(2001, 9, 2))).cast("timestamp_ntz"))
    sources = {code: rows.filter(F.col("region") == name) for code, name in labels.items()}
    results = [
        daily_batch.run_daily_batch(spark, sources, warehouse, dt.date(2001, 9, d), labels, max_failing_percentage=90.0) for d in (2, 3)
    ]
    assert all(r.loaded for r in results)
    assert [r.verification.first().status for r in results] == ["success"] * 2
    assert {r.status for r in results[-1].tests.collect()} == {"pass"}
    fact = fact_table.read_fact(spark, warehouse.path("fact"))
    assert fact.count() == fact.select("sale_id").distinct().count() > 100
    history = fact_table.read_history(spark, warehouse.path("fact"))
    assert history.filter("dbt_valid_to is null").count() == fact.count()
    kept, rebuilt = fact_table.read_daily(spark, warehouse.path("fact")), aggregates.daily_sales(fact, NOW)
    assert rows_of(kept) == rows_of(rebuilt)
    before = fact.count()
    held = daily_batch.run_daily_batch(spark, sources, warehouse, dt.date(2001, 9, 2), labels, min_records=10**9, max_failing_percentage=90.0)
    first = held.decision.first()
    assert not held.loaded and first.decision == "deletes_only" and "too few" in first.failure_reason
    assert held.tally.first().rows_inserted == 0
    failing = daily_batch.run_daily_batch(spark, sources, warehouse, dt.date(2001, 9, 2), labels)
    assert not failing.loaded and failing.tally is None and "too many failing rows" in failing.decision.first().failure_reason
    nothing = daily_batch.run_daily_batch(spark, sources, warehouse, dt.date(2001, 9, 20), labels)
    assert (nothing.decision.first().decision, nothing.loaded, nothing.tally) == ("no_data", False, None)
    assert fact_table.read_fact(spark, warehouse.path("fact")).count() <= before
    assert FACT_COLUMNS == fact.columns

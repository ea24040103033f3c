"""Small frames with known results."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

from tidemark import functions as fn
from tidemark.operators import aggregates, dedup, enrich, gate, incremental, merge, quality, snapshot, staging
from tidemark.schemas import EXTRACT_COLUMNS, FACT_COLUMNS, schema_of

T = dt.datetime
AT = T(2024, 1, 15, 10)


def extract_row(sale_id, product="P001", qty=2, price="10.00", total="20.00", region="us_east", discount="0", tax="2.00", pay="credit", hour=10, deleted=False, updated=AT):
    values = {
        "sale_id": sale_id,
        "customer_id": f"C{sale_id:03}",
        "product_id": product,
        "store_id": f"S{sale_id:03}",
        "sale_date": T(2024, 1, 15, hour),
        "quantity": qty,
        "unit_price": D(price),
        "total_amount": D(total),
        "discount_amount": None if discount is None else D(discount),
        "tax_amount": None if tax is None else D(tax),
        "payment_method": pay,
        "created_at": AT,
        "updated_at": updated,
        "is_deleted": deleted,
        "region": region,
        "etl_batch_id": "20240116",
    }
    return tuple(values[name] for name in EXTRACT_COLUMNS)


@pytest.fixture()
def batch(spark):
    second = extract_row(2, "P002", 1, "20.00", "20.00", "us_west", "2.00", "1.80", "cash", 11)
    rows = [
        extract_row(1),
        second,
        extract_row(3, "P003", 3, "15.00", "45.00", "europe", "5.00", "4.50", hour=12),
        second,
        extract_row(4, "P004", 5, "8.00", "40.00", "asia_pacific", None, "4.00", "debit", 13),
    ]
    return spark.createDataFrame(rows, schema_of(EXTRACT_COLUMNS))


def test_transform_batch(batch):
    out = {r.sale_id: r for r in staging.transform_batch(batch, AT, "20240116").collect()}
    assert sorted(out) == [1, 2, 3, 4]
    assert out[4].discount_amount == 0
    assert (out[1].net_amount, out[2].net_amount, out[1].gross_profit) == (D("20.00"), D("18.00"), D("18.00"))
    assert (out[3].sale_year, out[3].sale_month, out[3].sale_day) == (2024, 1, 15)
    assert [out[i].region for i in (1, 2, 3, 4)] == ["US-EAST", "US-WEST", "EUROPE", "ASIA-PACIFIC"]


def test_transform_keeps_markers_out_of_rules(spark):
    rows = [extract_row(1), extract_row(2, qty=0, deleted=True), extract_row(3, qty=0)]
    out = staging.transform_batch(spark.createDataFrame(rows, schema_of(EXTRACT_COLUMNS)), AT, "b")
    assert {(r.sale_id, r.is_deleted) for r in out.collect()} == {(1, False), (2, True)}


def test_transform_metrics(batch):
    row = gate.transform_metrics(batch, staging.transform_batch(batch, AT, "b"), "b").first()
    assert (row.total_extracted, row.duplicates_removed, row.transformed_records, row.delete_markers) == (5, 1, 4, 0)
    empty = batch.limit(0)
    none = gate.transform_metrics(empty, staging.transform_batch(empty, AT, "b"), "b").first()
    assert (none.total_extracted, none.status) == (0, "no_data")


@pytest.mark.parametrize(
    ("quantity", "price", "total", "customer", "product", "reason"),
    [
        (5, "10", "50", "c", "p", None),
        (0, "10", "0", "c", "p", "invalid_quantity"),
        (-5, "10", "-50", "c", "p", "invalid_quantity"),
        (5, "-10", "-50", "c", "p", "invalid_price"),
        (5, "10", "0", "c", "p", "invalid_amount"),
        (5, "10", "10", "c", "p", "failed_amount_sanity"),
        (5, "10", "150", "c", "p", "failed_amount_sanity"),
        (5, "10", "25", "c", "p", None),
        (5, "10", "100", "c", "p", None),
        (None, "10", "50", "c", "p", "failed_amount_sanity"),
        (5, "10", "50", None, "p", "missing_customer"),
        (5, "10", "50", "c", None, "missing_product"),
    ],
)
def test_validation_reason(spark, quantity, price, total, customer, product, reason):
    df = spark.createDataFrame(
        [(quantity, D(price), D(total), customer, product)],
        "quantity int, unit_price decimal(10,2), total_amount decimal(10,2), customer_id string, product_id string",
    ).withColumn("is_amount_valid", fn.amount_is_plausible())
    assert enrich.with_reason(df).first().validation_failure_reason == reason


def test_derived_amounts(spark):
    df = spark.createDataFrame(
        [(D("100"), D("10"), D("5")), (D("100.00"), D("15.00"), D("8.50"))],
        "total_amount decimal(10,2), discount_amount decimal(10,2), tax_amount decimal(10,2)",
    )
    got = {(r.net_amount, r.gross_profit) for r in enrich.derive_amounts(df).collect()}
    assert got == {(D("90.00"), D("85.00")), (D("85.00"), D("76.50"))}


def _changes(spark, rows):
    return spark.createDataFrame(rows, "sale_id long, total_amount int, is_deleted boolean")


def test_upsert_and_merge(spark):
    target = spark.createDataFrame([(1, 100), (2, 200), (3, 300)], "sale_id long, total_amount int")
    delta = spark.createDataFrame([(2, 250), (4, 400)], "sale_id long, total_amount int")
    assert dict(merge.upsert(target, delta, AT).collect()) == {1: 100, 2: 250, 3: 300, 4: 400}

    actions = merge.merge_changes(target, _changes(spark, [(2, 250, False), (3, 300, True), (4, 400, None), (9, 1, True)]), AT)
    assert dict(merge.merged(actions).collect()) == {1: 100, 2: 250, 4: 400}
    assert tuple(merge.merge_tally(actions).first()) == (1, 1, 1)


def test_batch_window():
    window = fn.batch_window(dt.date(2024, 1, 16))
    assert window == (T(2024, 1, 15), T(2024, 1, 16), "20240116")


def test_month_slices():
    day = dt.date
    assert incremental.month_slices(day(2023, 11, 1), day(2024, 3, 1), 3) == [
        (day(2023, 11, 1), day(2024, 2, 1)),
        (day(2024, 2, 1), day(2024, 3, 1)),
    ]


def test_split_leaves_out_null_flag(spark):
    df = spark.createDataFrame([(10, False), (20, False), (30, True), (40, False), (50, None)], "sale_id long, is_deleted boolean")
    assert staging.split_live(df).count() == 3
    assert staging.split_deleted(df).count() == 1


def test_region_counts(spark):
    rows = [("us_east",)] * 15 + [("us_west",)] * 12 + [("asia_pacific",)] * 8
    config = spark.createDataFrame([(n,) for n in ("us_east", "us_west", "europe", "asia_pacific")], "name string")
    out = gate.extraction_counts(spark.createDataFrame(rows, "region string"), config).collect()
    assert {r.region: r.record_count for r in out} == {"us_east": 15, "us_west": 12, "europe": 0, "asia_pacific": 8}
    assert {r.total_extracted for r in out} == {35}


def _gate_frame(spark, rows, nulls=0, bad=0):
    base = spark.range(rows).select(
        F.lit("b").alias("etl_batch_id"),
        F.col("id").alias("sale_id"),
        F.when(F.col("id") >= nulls, "c").alias("customer_id"),
        F.lit("p").alias("product_id"),
        F.lit(AT).alias("sale_date"),
        F.lit(2).alias("quantity"),
        F.lit(D("10.00")).alias("unit_price"),
        F.when(F.col("id") < bad, D("500.00")).otherwise(D("20.00")).alias("total_amount"),
        F.lit("EUROPE").alias("region"),
    )
    return gate.batch_gate(base)


def test_gate(spark):
    assert _gate_frame(spark, 1000, nulls=30).first().decision == gate.LOAD
    assert _gate_frame(spark, 1000, nulls=50).first().decision == gate.LOAD
    assert "customer_id" in _gate_frame(spark, 1000, nulls=51).first().failure_reason
    assert "too few" in _gate_frame(spark, 99).first().failure_reason
    assert "business rules" in _gate_frame(spark, 100, bad=1).first().failure_reason
    assert "missing columns" in gate.batch_gate(_gate_frame(spark, 100).drop("decision")).first().failure_reason


def test_latest_event_order(spark):
    df = spark.createDataFrame(
        [(1, T(2024, 1, 1), 5, False, "old"), (1, T(2024, 1, 2), 1, False, "new"), (2, T(2024, 1, 1), 1, False, "low"), (2, T(2024, 1, 1), 2, True, "high"), (3, None, 9, False, "null"), (3, T(2024, 1, 1), 1, False, "set")],
        "sale_id long, _cdc_source_ts timestamp_ntz, _kafka_offset long, is_deleted boolean, product_id string",
    )
    assert {r.sale_id: r.product_id for r in dedup.latest_event_per_key(df).collect()} == {1: "new", 2: "high", 3: "set"}


def _price_history(spark, rows):
    return spark.createDataFrame(rows, "sale_id long, amount int, updated_at timestamp_ntz")


def test_snapshot_example(spark):
    first = snapshot.first_snapshot(_price_history(spark, [(1000, 10, T(2024, 1, 1)), (1, 1, T(2024, 1, 1)), (2, 2, T(2024, 1, 1))]))
    source = _price_history(spark, [(1000, 15, T(2024, 1, 5)), (2, 99, T(2024, 1, 1)), (7, 7, T(2024, 1, 6))])
    history = snapshot.take_snapshot(first, source, T(2024, 1, 9))
    rows = {(r.sale_id, r.amount): (r.dbt_valid_from, r.dbt_valid_to) for r in history.collect()}
    assert rows[(1000, 10)] == (T(2024, 1, 1), T(2024, 1, 5))
    assert rows[(1000, 15)] == (T(2024, 1, 5), None)
    assert rows[(1, 1)] == (T(2024, 1, 1), T(2024, 1, 9))
    assert rows[(2, 2)] == (T(2024, 1, 1), None)
    assert rows[(7, 7)] == (T(2024, 1, 6), None)
    at_third = {r.sale_id: r.amount for r in snapshot.versions_at(history, T(2024, 1, 3)).collect()}
    assert at_third[1000] == 10
    back = snapshot.take_snapshot(history, _price_history(spark, [(1, 5, T(2024, 1, 12))]), T(2024, 1, 13))
    assert {(r.amount, r.dbt_valid_to) for r in back.filter("sale_id = 1").collect()} == {(1, T(2024, 1, 9)), (5, None)}


def test_schema_policies(spark):
    old = spark.createDataFrame([(1, "a")], "k long, x string")
    new = spark.createDataFrame([(2, 9)], "k long, y int")
    assert merge.append_rows(old, new).columns == ["k", "x", "y"]
    assert merge.append_rows(old, new, "ignore").columns == ["k", "x"]
    assert merge.append_rows(old, new, "sync_all_columns").columns == ["k", "y"]
    with pytest.raises(merge.SchemaChangeError):
        merge.append_rows(old, new, "fail")


def test_contract(spark):
    df = spark.createDataFrame([(1, "a")], "sale_id long, extra string")
    breaches = quality.contract_breaches(df, schema_of(["sale_id", "region"]))
    assert breaches == ["region: missing", "extra: not in contract"]
    assert quality.contract_breaches(spark.createDataFrame([], schema_of(FACT_COLUMNS)), schema_of(FACT_COLUMNS)) == []


def test_freshness_limits(spark):
    def status(hours):
        df = spark.createDataFrame([(AT - dt.timedelta(hours=hours),)], "loaded timestamp_ntz")
        return quality.freshness(df, AT, "loaded", 2, 6).first().status

    assert [status(h) for h in (1, 2, 3, 6, 7)] == ["pass", "pass", "warn", "warn", "error"]


def test_missing_days(spark):
    days = [(dt.date(2024, 1, 1), "A"), (dt.date(2024, 1, 9), "A"), (dt.date(2024, 1, 9), "B"), (dt.date(2024, 1, 10), "B")]
    out = quality.missing_days(spark.createDataFrame(days, "sale_date date, region string"), dt.date(2024, 1, 10))
    assert [tuple(r) for r in out.collect()] == [(dt.date(2024, 1, 10), "A")]
    none = spark.createDataFrame(days[:1], "sale_date date, region string")
    assert quality.missing_days(none, dt.date(2024, 6, 1)).count() == 0


def test_spine_and_gap_fill(spark):
    assert fn.date_spine(spark, dt.date(2024, 2, 27), dt.date(2024, 3, 1)).count() == 4
    daily = spark.createDataFrame([(dt.date(2024, 1, 2), "A", 3, D("5.00"))], "sale_date date, region string, order_count long, net_revenue decimal(18,2)")
    out = aggregates.gap_filled_daily(daily, dt.date(2024, 1, 1), dt.date(2024, 1, 3)).orderBy("sale_date").collect()
    assert [r.order_count for r in out] == [0, 3, 0]


def test_exact_average_rounds_once(spark):
    df = spark.createDataFrame([(D("0.01"),), (D("0.02"),)] + [(D("0.00"),)] * 4, "v decimal(10,2)")
    assert df.agg(fn.exact_avg("v")).first()[0] == D("0.01")
    assert df.limit(0).agg(fn.exact_avg("v")).first()[0] is None


def test_run_fails_only_on_errors(spark):
    df = spark.createDataFrame([(None, "x"), (1, "y")], "a int, b string")
    warned = quality.run_tests(df, [quality.not_null("a", quality.WARN), quality.not_null("b")])
    assert quality.run_fails(warned).first().run_ok
    failed = quality.run_tests(df, [quality.not_null("a")])
    assert not quality.run_fails(failed).first().run_ok


def test_batch_decisions(spark):
    live = "etl_batch_id string, sale_id long, customer_id string, product_id string, sale_date timestamp_ntz, total_amount decimal(10,2), validation_failure_reason string"
    good = (1, "c", "p", AT, D("1"), None)
    rows = [("full", *good)] * 10 + [("few", *good)] * 2 + [("small", *good)] * 2 + [("nulls", 1, None, "p", AT, D("1"), "missing_customer")] * 10
    rows += [("failing", *good)] * 8 + [("failing", *good[:-1], "invalid_price")] * 2 + [("some", *good)] * 19 + [("some", *good[:-1], "invalid_price")]
    markers = spark.createDataFrame([(b,) for b in ("small", "gone", "nulls", "full")], "etl_batch_id string")
    due = spark.createDataFrame([(b,) for b in ("full", "empty", "gone")], "etl_batch_id string")
    got = gate.batch_decisions(due, spark.createDataFrame(rows, live), markers, min_records=5).collect()
    assert {r.etl_batch_id: (r.decision, r.total_records, r.delete_markers) for r in got} == {
        "full": ("load", 10, 1), "few": ("quarantine", 2, 0), "small": ("deletes_only", 2, 1), "nulls": ("quarantine", 10, 1),
        "failing": ("quarantine", 10, 0), "some": ("load", 20, 0), "empty": ("no_data", 0, 0), "gone": ("deletes_only", 0, 1),
    }
    reasons = {r.etl_batch_id: r.failure_reason for r in got}
    assert reasons["nulls"] == "too many NULLs in customer_id: 10" and reasons["failing"] == "too many failing rows: 2"
    assert reasons["full"] is None and reasons["gone"] == "too few records: 0"


def test_row_count_between(spark):
    df = spark.createDataFrame([("a", 1), ("a", 2), ("b", 3)], "k string, v int")
    got = [quality.row_count_results(df, 1).first(), quality.row_count_results(df, 4).first(), quality.row_count_results(df, 2, by="k").first()]
    assert [(r.test, r.column_name, r.failures, r.status) for r in got] == [
        ("row_count_between", "*", 0, "pass"), ("row_count_between", "*", 1, "fail"), ("row_count_between", "k", 1, "fail")]
    assert quality.row_count_results(df.limit(0), 1).first().failures == 1


def test_extraction_counts_have_zeros_and_unknown_regions(spark):
    rows = spark.createDataFrame([("a",), ("a",), ("x",), (None,)], "region string")
    regions = spark.createDataFrame([("a",), ("b",)], "name string")
    got = {r.region: (r.record_count, r.total_extracted) for r in gate.extraction_counts(rows, regions).collect()}
    assert got == {"a": (2, 4), "b": (0, 4)}
    assert [tuple(r) for r in gate.extraction_counts(rows.limit(0), regions).orderBy("region").collect()] == [("a", 0, 0), ("b", 0, 0)]


def test_contract_write_leaves_the_table(spark):
    from pyspark.sql.types import IntegerType, StringType, StructField, StructType

    from tidemark.session import fresh_path
    from tidemark.sinks import contract

    path = fresh_path(spark, "contract")
    kept = StructType([StructField("k", StringType(), False), StructField("v", IntegerType())])
    rules = {"v below ten": F.col("v") < 10}
    df = spark.createDataFrame([("a", 1), ("b", None)], "k string, v int")
    contract.replace_slices(df, path, ["k"], kept, rules)
    for bad in (df.withColumn("v", F.col("v") + 9), df.withColumn("k", F.nullif("k", F.lit("b")))):
        with pytest.raises(Exception, match="contract broken"):
            contract.replace_slices(bad, path, ["k"], kept, rules)
    with pytest.raises(contract.ContractError, match="v: bigint instead of int"):
        contract.rebuild(df.withColumn("v", F.col("v").cast("bigint")), path, kept)
    assert {(r.k, r.v) for r in spark.read.parquet(path).collect()} == {("a", 1), ("b", None)}


def test_relations_pair_null_keys_and_count_columns_of_either_side(spark):
    left = spark.createDataFrame([(1, None, "a"), (None, 2, "b"), (3, 3, "c"), (4, 4, "d")], "k int, j int, v string")
    right = spark.createDataFrame([(1, None, "a", None), (None, 2, "b", "more"), (3, 3, "c", None), (5, 5, "e", None)], "k int, j int, v string, w string")
    want = {"same": 2, "different": 1, "only_left": 1, "only_right": 1}
    assert dict(quality.compare_relations(left, right, ["k", "j"]).collect()) == want
    for segments in (1, 3, 100):
        assert dict(quality.compare_by_segments(left, right, ["k", "j"], segments).collect()) == want
    assert dict(quality.compare_by_segments(left, left, ["k", "j"]).collect()) == {"same": 4}
    assert quality.compare_by_segments(left.limit(0), left.limit(0), ["k"]).collect() == []


def test_types_of_stored_generations(spark):
    from tidemark.session import fresh_path
    from tidemark.sinks import evolving

    path = fresh_path(spark, "evolving")
    evolving.append(spark.createDataFrame([(1, D("1.5"), 2)], "a int, d decimal(6,2), gone int"), path)
    evolving.append(spark.createDataFrame([(1 << 40, D("2.125"))], "a long, d decimal(8,3)"), path)
    evolving.append(spark.createDataFrame([(7, 3)], "a int, gone int"), path)
    rows = sorted(map(tuple, evolving.read(spark, path).collect()), key=str)
    assert rows == sorted([(1, D("1.500"), 2), (1 << 40, D("2.125"), None), (7, None, 3)], key=str)
    with pytest.raises(merge.SchemaChangeError, match="string does not go with bigint"):
        evolving.append(spark.createDataFrame([("x",)], "a string"), path)
    assert evolving.read(spark, path).count() == 3

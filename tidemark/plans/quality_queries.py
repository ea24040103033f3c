"""Registered queries: data tests, gate, reconciliation, freshness, comparison."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators import aggregates, gate, merge, quality, staging
from tidemark.plans import inputs
from tidemark.plans.oracle import AS_OF, CUT, quotient, sql
from tidemark.plans.registry import query
from tidemark.plans.row_queries import DAY
from tidemark.schemas import CRITICAL_COLUMNS
from tidemark.session import written
from tidemark.sources.extract import extract_window
from tidemark.sources.tables import REGIONS, table


def _live(spark: SparkSession, sf: str) -> DataFrame:
    return staging.split_live(inputs.sales(spark, sf))


_NULLS = ", ".join(f"count(*) FILTER (WHERE {c} IS NULL) AS null_{c}" for c in CRITICAL_COLUMNS)
_NULL_PCT = ", ".join(
    f"{quotient(f'CAST(null_{c} AS HUGEINT) * 10000', 'CAST(total_records AS HUGEINT)', 'DECIMAL(18,2)')} AS null_pct_{c}"
    for c in CRITICAL_COLUMNS
)


@query(sql("parsed", f"SELECT *, {_NULL_PCT} FROM (SELECT count(*) AS total_records, {_NULLS} FROM parsed) p"))
def null_profile(spark: SparkSession, sf: str) -> DataFrame:
    return gate.null_profile(inputs.staged_events(spark, sf))


_BROKEN = (
    "quantity <= 0 OR unit_price <= 0 OR total_amount <= 0 OR total_amount < quantity * unit_price * 0.5 "
    "OR total_amount > quantity * unit_price * 2.0"
)


@query(
    sql(
        "sales",
        f"SELECT etl_batch_id, count(*) AS row_count, count(*) FILTER (WHERE {_BROKEN}) AS invalid_records "
        "FROM sales WHERE NOT is_deleted GROUP BY etl_batch_id",
    )
)
def rule_violations(spark: SparkSession, sf: str) -> DataFrame:
    return gate.rule_violations(_live(spark, sf))


_GATE = f"""SELECT etl_batch_id, total_records, invalid_records,
  CASE WHEN failure_reason IS NULL THEN 'load' ELSE 'quarantine' END AS decision, failure_reason FROM (
  SELECT *, CASE WHEN total_records < {{least}} THEN 'too few records: ' || total_records
    {' '.join(f"WHEN null_{c} * 100 > 5.0 * total_records THEN 'too many NULLs in {c}: ' || null_{c}" for c in CRITICAL_COLUMNS)}
    WHEN invalid_records > 0 THEN 'business rules broken: ' || invalid_records END AS failure_reason
  FROM (SELECT etl_batch_id, count(*) AS total_records, {_NULLS},
      count(*) FILTER (WHERE {_BROKEN}) AS invalid_records FROM {{source}} GROUP BY etl_batch_id) g) d"""


@query(sql("fact", _GATE.format(source="fact", least=100)))
def dq_gate(spark: SparkSession, sf: str) -> DataFrame:
    return gate.batch_gate(inputs.fact(spark, sf))


@query(sql("sales", _GATE.format(source="(SELECT * FROM sales WHERE NOT is_deleted) live", least=100)))
def dq_gate_raw(spark: SparkSession, sf: str) -> DataFrame:
    return gate.batch_gate(_live(spark, sf))


@query(
    sql(
        "fact",
        f"SELECT f.* FROM fact f JOIN ({_GATE.format(source='fact', least=20)}) g ON f.etl_batch_id = g.etl_batch_id "
        "WHERE g.decision = 'load'",
    )
)
def gate_admitted_rows(spark: SparkSession, sf: str) -> DataFrame:
    # Rows and decisions are stored: the fact is built once, and the few decisions have a known size.
    fact = written(inputs.fact(spark, sf), "fact")
    decisions = written(gate.batch_gate(fact, min_records=20), "decisions")
    return gate.route_batches(fact, decisions)[0]


@query(
    sql(
        "sales",
        f"SELECT max(updated_at) AS max_loaded_at, CASE WHEN max(updated_at) IS NULL OR max(updated_at) + INTERVAL 6 HOUR < {AS_OF} "
        f"THEN 'error' WHEN max(updated_at) + INTERVAL 2 HOUR < {AS_OF} THEN 'warn' ELSE 'pass' END AS status FROM sales",
    )
)
def freshness(spark: SparkSession, sf: str) -> DataFrame:
    return quality.freshness(inputs.sales(spark, sf), inputs.AS_OF, "updated_at", 2, 6)


@query(
    sql(
        "actions",
        """SELECT coalesce(e.etl_batch_id, l.etl_batch_id) AS etl_batch_id, coalesce(expected_count, 0) AS expected_count,
  coalesce(actual_count, 0) AS actual_count,
  CASE WHEN coalesce(expected_count, 0) = coalesce(actual_count, 0) THEN 'success' ELSE 'mismatch' END AS status
FROM (SELECT etl_batch_id, count(*) AS expected_count FROM changes WHERE NOT is_deleted GROUP BY 1) e
FULL OUTER JOIN (SELECT c.etl_batch_id, count(*) AS actual_count FROM actions a JOIN changes c ON a.sale_id = c.sale_id
  WHERE a._merge_action IN ('insert', 'update') GROUP BY 1) l ON e.etl_batch_id = l.etl_batch_id""",
    )
)
def reconcile_batch(spark: SparkSession, sf: str) -> DataFrame:
    changes = written(inputs.changes(spark, sf), "changes")
    return gate.reconcile_load(changes, merge.merge_changes(inputs.old_fact(spark, sf), changes, inputs.AS_OF))


@query(sql("fact", "SELECT etl_batch_id, count(*) AS record_count FROM fact GROUP BY 1"))
def batch_row_count(spark: SparkSession, sf: str) -> DataFrame:
    return gate.batch_counts(inputs.fact(spark, sf))


@query(sql("sales", "SELECT sale_id, count(*) AS row_count FROM sales GROUP BY 1 HAVING count(*) > 1"))
def duplicate_keys(spark: SparkSession, sf: str) -> DataFrame:
    return quality.duplicate_keys(inputs.sales(spark, sf), ["sale_id"])


@query(
    sql(
        "sales",
        "SELECT etl_batch_id, count(*) FILTER (WHERE n > 1) AS duplicate_count FROM "
        "(SELECT etl_batch_id, sale_id, count(*) AS n FROM sales GROUP BY 1, 2) k GROUP BY 1",
    )
)
def duplicates_per_batch(spark: SparkSession, sf: str) -> DataFrame:
    return gate.duplicate_count(inputs.sales(spark, sf))


@query(
    sql(
        "sales",
        """SELECT lower(r_name) AS region, coalesce(n, 0) AS record_count, (SELECT count(*) FROM sales WHERE status = 'completed'
  AND updated_at >= TIMESTAMP '1998-06-01' AND updated_at < TIMESTAMP '1998-06-02') AS total_extracted
FROM region LEFT JOIN (SELECT region, count(*) AS n FROM sales WHERE status = 'completed'
  AND updated_at >= TIMESTAMP '1998-06-01' AND updated_at < TIMESTAMP '1998-06-02' GROUP BY 1) s ON r_name = s.region""",
    )
)
def extraction_counts(spark: SparkSession, sf: str) -> DataFrame:
    rows = extract_window(inputs.sales(spark, sf), DAY, more=["region"]).withColumn("region", F.lower("region"))
    regions = table(spark, sf, "region").select(F.lower("r_name").alias("name"))
    return gate.extraction_counts(rows, regions)


_DECISIONS = f"""SELECT etl_batch_id, total_records, delete_markers, failing_records,
  CASE WHEN total_records = 0 AND delete_markers = 0 THEN 'no_data' WHEN broken IS NOT NULL THEN 'quarantine'
    WHEN total_records < 5 AND delete_markers > 0 THEN 'deletes_only' WHEN total_records < 5 THEN 'quarantine' ELSE 'load' END AS decision,
  coalesce(broken, CASE WHEN total_records < 5 THEN 'too few records: ' || total_records END) AS failure_reason FROM (
  SELECT *, CASE {' '.join(f"WHEN null_{c} * 100 > 5.0 * total_records THEN 'too many NULLs in {c}: ' || null_{c}" for c in CRITICAL_COLUMNS)}
    WHEN failing_records * 100 > 75.0 * total_records THEN 'too many failing rows: ' || failing_records END AS broken
  FROM (SELECT e.etl_batch_id, coalesce(total_records, 0) AS total_records, coalesce(delete_markers, 0) AS delete_markers,
      coalesce(failing_records, 0) AS failing_records, {', '.join(f'coalesce(null_{c}, 0) AS null_{c}' for c in CRITICAL_COLUMNS)}
    FROM (SELECT strftime(unnest(generate_series(min(updated_at), max(updated_at) + INTERVAL 62 DAY, INTERVAL 1 DAY)), '%Y%m%d') AS etl_batch_id FROM sales) e
    LEFT JOIN (SELECT strftime(updated_at, '%Y%m%d') AS etl_batch_id, count(*) AS total_records,
        count(*) FILTER (WHERE validation_failure_reason IS NOT NULL) AS failing_records, {_NULLS} FROM checked GROUP BY 1) l USING (etl_batch_id)
    LEFT JOIN (SELECT strftime(updated_at, '%Y%m%d') AS etl_batch_id, count(*) AS delete_markers FROM sales
      WHERE status = 'completed' AND is_deleted GROUP BY 1) m USING (etl_batch_id)) c) d"""


@query(sql("checked", _DECISIONS, completed_only=True))
def batch_decisions(spark: SparkSession, sf: str) -> DataFrame:
    """A decision about every day that a batch was due, also those for which nothing or only deletes came."""
    rows = inputs.completed(spark, sf)
    span = inputs.sales(spark, sf).agg(F.min("updated_at").alias("first"), F.date_add(F.max("updated_at"), 62).alias("last"))
    due = span.select(F.explode(F.sequence(F.to_date("first"), "last", F.expr("interval 1 day"))).alias("day"))
    batch = F.date_format("updated_at", "yyyyMMdd")
    return gate.batch_decisions(
        due.select(F.date_format("day", "yyyyMMdd").alias("etl_batch_id")),
        inputs.checked(rows).withColumn("etl_batch_id", batch),
        staging.split_deleted(rows).withColumn("etl_batch_id", batch),
        min_records=5,
        max_failing_percentage=75.0,
    )


# --- data tests -----------------------------------------------------------------
def _status(failures: str, severity: str) -> str:
    bad = "warn" if severity == "warn" else "fail"
    return f"CASE WHEN {failures} = 0 THEN 'pass' ELSE '{bad}' END"


def _test_row(test: str, column: str, severity: str, failures: str, source: str) -> str:
    return (
        f"SELECT '{test}' AS test, '{column}' AS column_name, '{severity}' AS severity, {failures} AS failures, "
        f"{_status(failures, severity)} AS status FROM {source}"
    )


def _counted(condition: str) -> str:
    return f"count(*) FILTER (WHERE {condition})"


_UNIQUE = "(SELECT sale_id FROM {source} WHERE sale_id IS NOT NULL GROUP BY 1 HAVING count(*) > 1) d"


@query(sql("sales", _test_row("unique", "sale_id", "error", "count(*)", _UNIQUE.format(source="sales"))))
def test_unique(spark: SparkSession, sf: str) -> DataFrame:
    return quality.unique_results(inputs.sales(spark, sf), "sale_id")


_NOT_NULL = ["sale_id", "customer_id", "product_id", "sale_date", "quantity", "unit_price", "total_amount", "region", "discount_amount"]


@query(
    sql(
        "sales",
        " UNION ALL ".join(
            _test_row("not_null", c, "warn" if c == "discount_amount" else "error", _counted(f"{c} IS NULL"), "sales")
            for c in _NOT_NULL
        ),
    )
)
def test_not_null(spark: SparkSession, sf: str) -> DataFrame:
    tests = [quality.not_null(c, quality.WARN if c == "discount_amount" else quality.ERROR) for c in _NOT_NULL]
    return quality.row_test_results(inputs.sales(spark, sf), tests)


@query(
    sql(
        "sales",
        _test_row("accepted_values", "payment_method", "error", _counted("payment_method NOT IN ('credit', 'cash', 'debit')"), "sales")
        + " UNION ALL "
        + _test_row("accepted_values", "region", "error", _counted("region NOT IN ('AFRICA', 'AMERICA', 'ASIA', 'EUROPE', 'MIDDLE EAST')"), "sales"),
    )
)
def test_accepted(spark: SparkSession, sf: str) -> DataFrame:
    tests = [
        quality.accepted_values("payment_method", ["credit", "cash", "debit"]),
        quality.accepted_values("region", REGIONS),
    ]
    return quality.row_test_results(inputs.sales(spark, sf), tests)


@query(
    sql(
        "parsed",
        " UNION ALL ".join(
            [
                _test_row("between", "quantity", "error", _counted("quantity < 1"), "parsed"),
                _test_row("between", "unit_price", "error", _counted("unit_price < 0.01"), "parsed"),
                _test_row("between", "total_amount", "warn", _counted("total_amount < 0.01 OR total_amount > 100"), "parsed"),
            ]
        ),
    )
)
def test_between(spark: SparkSession, sf: str) -> DataFrame:
    cent = Decimal("0.01")
    tests = [
        quality.between("quantity", 1),
        quality.between("unit_price", cent),
        quality.between("total_amount", cent, Decimal("100"), quality.WARN),
    ]
    return quality.row_test_results(inputs.staged_events(spark, sf), tests)


@query(
    sql(
        "parsed",
        " UNION ALL ".join(
            [
                _test_row("positive_value", "gross_profit", "warn", _counted("gross_profit < 0"), "parsed"),
                _test_row("length_between", "customer_id", "error", _counted("NOT (length(customer_id) BETWEEN 2 AND 3)"), "parsed"),
                _test_row("matches", "store_id", "error", _counted("NOT regexp_matches(store_id, '^S1')"), "parsed"),
            ]
        ),
    )
)
def test_generic(spark: SparkSession, sf: str) -> DataFrame:
    tests = [
        quality.positive_value("gross_profit", quality.WARN),
        quality.length_between("customer_id", 2, 3),
        quality.matches("store_id", "^S1"),
    ]
    return quality.row_test_results(inputs.staged_events(spark, sf), tests)


@query(
    sql(
        "sales",
        _test_row(
            "relationships",
            "customer_id",
            "warn",
            "count(*)",
            "sales WHERE customer_id IS NOT NULL AND customer_id NOT IN (SELECT CAST(user_id AS VARCHAR) FROM events)",
        ),
    )
)
def test_relationships(spark: SparkSession, sf: str) -> DataFrame:
    """Every customer of a sale should be known as a user of the event log."""
    users = table(spark, sf, "events").select(F.col("user_id").cast("string").alias("customer_id"))
    return quality.relationship_results(inputs.sales(spark, sf), users.distinct(), "customer_id", severity=quality.WARN)


@query(
    sql(
        "fact parsed",
        "SELECT store_id, count(*) AS orphan_count FROM fact WHERE store_id NOT IN "
        "(SELECT substr(store_id, 2) FROM parsed WHERE store_id IS NOT NULL) GROUP BY store_id",
        completed_only=True,
    )
)
def orphan_stores(spark: SparkSession, sf: str) -> DataFrame:
    """Stores of the fact that no change event names."""
    named = inputs.staged_events(spark, sf).select(F.substring("store_id", 2, 20).alias("store_id"))
    return quality.orphan_keys(inputs.fact(spark, sf, completed_only=True), named.distinct(), "store_id")


@query(
    sql(
        "sales fact",
        _test_row("row_count_between", "*", "error", _counted("n < 1"), "(SELECT count(*) AS n FROM sales) c")
        + " UNION ALL "
        + _test_row("row_count_between", "etl_batch_id", "warn", _counted("n < 20 OR n > 250"), "(SELECT count(*) AS n FROM fact GROUP BY etl_batch_id) c"),
        completed_only=True,
    )
)
def test_row_count(spark: SparkSession, sf: str) -> DataFrame:
    """The source has rows at all, and each batch of the fact about as many as usual."""
    whole = quality.row_count_results(inputs.sales(spark, sf), 1)
    return whole.unionByName(quality.row_count_results(inputs.fact(spark, sf, completed_only=True), 20, 250, quality.WARN, by="etl_batch_id"))


@query(
    sql(
        "daily",
        """SELECT d.sale_date, e.region FROM (SELECT DISTINCT sale_date FROM daily WHERE sale_date >= DATE '2001-08-01' - 7) d
CROSS JOIN (SELECT DISTINCT region FROM daily) e
LEFT JOIN daily a ON a.sale_date = d.sale_date AND a.region = e.region WHERE a.sale_date IS NULL""",
    )
)
def daily_completeness(spark: SparkSession, sf: str) -> DataFrame:
    daily = aggregates.daily_sales(inputs.fact(spark, sf), inputs.AS_OF)
    return quality.missing_days(daily, inputs.AS_OF.date(), 7)


@query(
    sql(
        "fact stores",
        " UNION ALL ".join(
            [
                *[
                    _test_row("not_null", c, "warn" if c in ("net_amount", "gross_profit") else "error", _counted(f"{c} IS NULL"), "fact")
                    for c in ("sale_id", "customer_id", "store_id", "sale_date", "region", "net_amount", "gross_profit")
                ],
                _test_row("unique", "sale_id", "error", "count(*)", _UNIQUE.format(source="fact")),
                _test_row("relationships", "store_id", "warn", "count(*)", "fact WHERE store_id NOT IN (SELECT store_id FROM stores)"),
            ]
        ),
        completed_only=True,
    )
)
def fact_test_suite(spark: SparkSession, sf: str) -> DataFrame:
    fact = inputs.fact(spark, sf, completed_only=True)
    rows = [
        quality.not_null(c, quality.WARN if c in ("net_amount", "gross_profit") else quality.ERROR)
        for c in ("sale_id", "customer_id", "store_id", "sale_date", "region", "net_amount", "gross_profit")
    ]
    stores = aggregates.dim_stores(fact, inputs.AS_OF)
    return quality.run_tests(fact, rows, [("sale_id", quality.ERROR)], [("store_id", stores, quality.WARN)])


@query(
    sql(
        "parsed",
        """SELECT _kafka_offset, sale_id, array_to_string(list_filter([
  CASE WHEN customer_id IS NULL THEN 'not_null(customer_id)' END, CASE WHEN quantity < 1 THEN 'between(quantity)' END,
  CASE WHEN gross_profit < 0 THEN 'positive_value(gross_profit)' END], lambda x: x IS NOT NULL), ',') AS failed_tests
FROM parsed WHERE customer_id IS NULL OR quantity < 1 OR gross_profit < 0""",
    )
)
def stored_failures(spark: SparkSession, sf: str) -> DataFrame:
    tests = [quality.not_null("customer_id"), quality.between("quantity", 1), quality.positive_value("gross_profit")]
    failing = quality.failing_rows(inputs.staged_events(spark, sf), tests)
    return failing.select("_kafka_offset", "sale_id", F.array_join("failed_tests", ",").alias("failed_tests"))


_COMPARED = f"""SELECT CASE WHEN n.sale_id IS NULL THEN 'only_left' WHEN o.sale_id IS NULL THEN 'only_right'
  WHEN o.updated_at = n.updated_at AND o.product_id = n.product_id AND o.store_id = n.store_id AND o.total_amount = n.total_amount
   AND o.quantity = n.quantity AND o.net_amount = n.net_amount AND o.gross_profit = n.gross_profit
   AND o._cdc_operation = n._cdc_operation THEN 'same' ELSE 'different' END AS outcome, count(*) AS row_count
FROM old_fact o FULL OUTER JOIN fact n ON o.sale_id = n.sale_id GROUP BY 1"""


@query(sql("old_fact fact", _COMPARED))
def compare_relations(spark: SparkSession, sf: str) -> DataFrame:
    stamps = ("_row_inserted_at", "_row_updated_at")
    old, new = inputs.old_fact(spark, sf).drop(*stamps), inputs.fact(spark, sf).drop(*stamps)
    return quality.compare_relations(old, new, ["sale_id"])


@query(sql("old_fact fact", _COMPARED, completed_only=True))
def compare_segments(spark: SparkSession, sf: str) -> DataFrame:
    """The same comparison by digests of segments of stored tables."""
    stamps = ("_row_inserted_at", "_row_updated_at")
    facts = (of(spark, sf, completed_only=True) for of in (inputs.old_fact, inputs.fact))
    old, new = (written(df.drop(*stamps), "compared") for df in facts)
    return quality.compare_by_segments(old, new, ["sale_id"])


@query(
    sql(
        "sales",
        f"""SELECT *, 'left' AS side FROM (SELECT sale_id, product_id, total_amount FROM sales WHERE updated_at < {CUT}
  EXCEPT ALL SELECT sale_id, product_id, total_amount FROM sales WHERE NOT is_deleted) a
UNION ALL SELECT *, 'right' AS side FROM (SELECT sale_id, product_id, total_amount FROM sales WHERE NOT is_deleted
  EXCEPT ALL SELECT sale_id, product_id, total_amount FROM sales WHERE updated_at < {CUT}) b""",
    )
)
def row_differences(spark: SparkSession, sf: str) -> DataFrame:
    columns = ["sale_id", "product_id", "total_amount"]
    return quality.row_differences(inputs.before_cut(spark, sf).select(*columns), _live(spark, sf).select(*columns))

"""SQL building blocks for the checks: the same frames in plain SQL.

``sql("fact", "SELECT ...")`` puts the common table expressions that ``fact``
needs in front of the statement.
"""

from __future__ import annotations

AS_OF = "TIMESTAMP '2001-08-01 00:00:00'"
CUT = "TIMESTAMP '2000-07-01 00:00:00'"
EVENTS_AS_OF = "TIMESTAMP '2024-03-01 00:00:00'"

CONTENT = (
    "product_id NULLS LAST, store_id NULLS LAST, total_amount NULLS LAST, quantity NULLS LAST, "
    "discount_amount NULLS LAST, tax_amount NULLS LAST, _cdc_operation NULLS LAST"
)


def money(expression: str, kind: str = "DECIMAL(18,2)") -> str:
    return f"CAST({expression} AS {kind})"


def cents(expression: str) -> str:
    """A two-place decimal as a whole number of cents."""
    return f"CAST(({expression}) * 100 AS HUGEINT)"


def quotient(numerator: str, denominator: str, kind: str = "DECIMAL(10,2)") -> str:
    """Whole-number quotient in hundredths, rounded half away from zero, as a decimal.

    ``numerator`` counts hundredths of ``denominator``'s unit.
    """
    rounded = (
        f"(CASE WHEN ({numerator}) < 0 THEN -1 ELSE 1 END * "
        f"((2 * abs({numerator}) + ({denominator})) // (2 * ({denominator}))))"
    )
    return f"CAST(CAST({rounded} AS DECIMAL(30,0)) * CAST(0.01 AS DECIMAL(3,2)) AS {kind})"


def average(column: str, kind: str = "DECIMAL(10,2)") -> str:
    """Average of a two-place decimal column, rounded half up once."""
    return quotient(cents(f"sum(CAST({column} AS DECIMAL(18,2)))"), f"CAST(count({column}) AS HUGEINT)", kind)


SALES = f"""sales AS (
  SELECT l_orderkey * 10 + l_linenumber AS sale_id,
    CAST(o_custkey AS VARCHAR) AS customer_id, CAST(l_partkey AS VARCHAR) AS product_id,
    CAST(l_suppkey AS VARCHAR) AS store_id, o_orderdate AS sale_date, o_orderdate AS created_at,
    l_shipdate AS updated_at, CAST(l_quantity AS INTEGER) AS quantity,
    CAST(p_retailprice AS DECIMAL(10,2)) AS unit_price, CAST(l_extendedprice AS DECIMAL(10,2)) AS total_amount,
    CASE WHEN l_discount <> 0 THEN
      CAST(CAST(l_extendedprice AS DECIMAL(12,2)) * CAST(l_discount AS DECIMAL(4,2)) AS DECIMAL(10,2)) END AS discount_amount,
    CASE WHEN l_tax <> 0 THEN
      CAST(CAST(l_extendedprice AS DECIMAL(12,2)) * CAST(l_tax AS DECIMAL(4,2)) AS DECIMAL(10,2)) END AS tax_amount,
    r_name AS region,
    CASE o_orderpriority WHEN '1-URGENT' THEN 'credit' WHEN '2-HIGH' THEN 'cash' WHEN '3-MEDIUM' THEN 'debit'
      ELSE 'other' END AS payment_method,
    CASE o_orderstatus WHEN 'F' THEN 'completed' WHEN 'O' THEN 'open' ELSE 'pending' END AS status,
    l_returnflag = 'R' AS is_deleted,
    CASE l_returnflag WHEN 'N' THEN 'c' WHEN 'A' THEN 'u' WHEN 'R' THEN 'd' END AS _cdc_operation,
    l_shipdate AS _cdc_source_ts, strftime(l_shipdate, '%Y%m') AS etl_batch_id, l_shipdate AS etl_loaded_at
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey
    JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
    JOIN region ON n_regionkey = r_regionkey)"""

STAGED_LIST = (
    "sale_id, customer_id, product_id, store_id, sale_date, created_at, updated_at, quantity, unit_price, "
    "total_amount, discount_amount, tax_amount, region, payment_method, is_deleted, _cdc_operation, "
    "_cdc_source_ts, etl_batch_id, etl_loaded_at"
)
DATA_LIST = (
    "sale_id, customer_id, product_id, store_id, sale_date, created_at, updated_at, quantity, unit_price, "
    "total_amount, discount_amount, tax_amount, net_amount, gross_profit, region, payment_method, sale_year, "
    "sale_month, sale_day, _cdc_operation, _cdc_source_ts, etl_batch_id, etl_loaded_at"
)
UPDATED_LIST = [name for name in DATA_LIST.split(", ") if name not in ("sale_id", "created_at")]


def chain(prefix: str, where: str, stamp: str, kept: str) -> dict[str, str]:
    """Staged, checked and fact rows of the sales rows that satisfy ``kept`` and ``where``."""
    return {
        f"{prefix}staged": f"""{prefix}staged AS (
  SELECT sale_id, customer_id, product_id, store_id, sale_date, created_at, updated_at, quantity, unit_price,
    total_amount, coalesce(discount_amount, CAST(0 AS DECIMAL(10,2))) AS discount_amount,
    coalesce(tax_amount, CAST(0 AS DECIMAL(10,2))) AS tax_amount, region, payment_method, is_deleted,
    _cdc_operation, _cdc_source_ts, etl_batch_id, etl_loaded_at
  FROM (SELECT *, row_number() OVER (PARTITION BY sale_id
          ORDER BY updated_at DESC NULLS LAST, _cdc_source_ts DESC NULLS LAST, {CONTENT}) AS rn
        FROM sales WHERE {kept}etl_batch_id IS NOT NULL AND NOT is_deleted AND {where}) ranked
  WHERE rn = 1)""",
        f"{prefix}checked": f"""{prefix}checked AS (
  SELECT *, CASE WHEN quantity <= 0 THEN 'invalid_quantity' WHEN unit_price <= 0 THEN 'invalid_price'
      WHEN total_amount <= 0 THEN 'invalid_amount' WHEN NOT is_amount_valid THEN 'failed_amount_sanity'
      WHEN customer_id IS NULL THEN 'missing_customer' WHEN product_id IS NULL THEN 'missing_product' END
      AS validation_failure_reason
  FROM (SELECT *, CAST(total_amount - discount_amount AS DECIMAL(10,2)) AS net_amount,
      CAST(total_amount - discount_amount - tax_amount AS DECIMAL(10,2)) AS gross_profit,
      CAST(year(sale_date) AS INTEGER) AS sale_year, CAST(month(sale_date) AS INTEGER) AS sale_month,
      CAST(day(sale_date) AS INTEGER) AS sale_day,
      coalesce(total_amount >= quantity * unit_price * 0.5 AND total_amount <= quantity * unit_price * 2.0, false)
        AS is_amount_valid
    FROM {prefix}staged) enriched)""",
        f"{prefix}fact": f"""{prefix}fact AS (
  SELECT {DATA_LIST}, {stamp} AS _row_inserted_at, {stamp} AS _row_updated_at
  FROM {prefix}checked WHERE validation_failure_reason IS NULL)""",
    }


def changes(kept: str) -> str:
    """One change per key since the cut, of the sales rows that satisfy ``kept``."""
    return f"""changes AS (
  SELECT {DATA_LIST}, is_deleted FROM (
    SELECT *, row_number() OVER (PARTITION BY sale_id
      ORDER BY updated_at DESC NULLS LAST, is_deleted DESC NULLS LAST, {CONTENT}) AS rn
    FROM (
      SELECT {DATA_LIST}, is_deleted FROM new_checked WHERE validation_failure_reason IS NULL
      UNION ALL BY NAME
      SELECT {STAGED_LIST} FROM sales WHERE {kept}is_deleted AND updated_at >= {CUT}) both_kinds) ranked
  WHERE rn = 1)"""

ACTIONS = f"""actions AS (
  SELECT coalesce(t.sale_id, c.sale_id) AS sale_id,
    CASE WHEN c.sale_id IS NULL THEN 'keep' WHEN t.sale_id IS NOT NULL AND c.is_deleted THEN 'delete'
      WHEN c.is_deleted THEN 'skip' WHEN t.sale_id IS NOT NULL THEN 'update' ELSE 'insert' END AS _merge_action
  FROM old_fact t FULL OUTER JOIN changes c ON t.sale_id = c.sale_id)"""

_SET = ", ".join(f"CASE WHEN a._merge_action = 'keep' THEN t.{n} ELSE c.{n} END AS {n}" for n in UPDATED_LIST)
MERGED = f"""merged AS (
  SELECT a.sale_id, CASE WHEN a._merge_action = 'insert' THEN c.created_at ELSE t.created_at END AS created_at, {_SET},
    CASE WHEN a._merge_action = 'insert' THEN {AS_OF} ELSE t._row_inserted_at END AS _row_inserted_at,
    CASE WHEN a._merge_action = 'keep' THEN t._row_updated_at ELSE {AS_OF} END AS _row_updated_at
  FROM actions a LEFT JOIN old_fact t ON a.sale_id = t.sale_id LEFT JOIN changes c ON a.sale_id = c.sale_id
  WHERE a._merge_action IN ('keep', 'update', 'insert'))"""


def daily(source: str) -> str:
    """Daily KPIs of a fact relation."""
    return f"""SELECT CAST(sale_date AS DATE) AS sale_date, region, count(*) AS order_count,
    CAST(sum(quantity) AS BIGINT) AS total_units_sold, count(DISTINCT customer_id) AS unique_customers,
    count(DISTINCT store_id) AS active_stores, {money('sum(total_amount)')} AS gross_revenue,
    {money('sum(discount_amount)')} AS total_discounts, {money('sum(tax_amount)')} AS total_tax,
    {money('sum(net_amount)')} AS net_revenue, {money('sum(gross_profit)')} AS gross_profit,
    {average('total_amount')} AS avg_order_value, {average('quantity')} AS avg_units_per_order,
    CAST(sum(CASE WHEN payment_method = 'credit' THEN 1 ELSE 0 END) AS BIGINT) AS credit_orders,
    CAST(sum(CASE WHEN payment_method = 'cash' THEN 1 ELSE 0 END) AS BIGINT) AS cash_orders,
    CAST(sum(CASE WHEN payment_method = 'debit' THEN 1 ELSE 0 END) AS BIGINT) AS debit_orders,
    max(etl_batch_id) AS latest_batch_id, {AS_OF} AS _aggregated_at
  FROM {source} GROUP BY CAST(sale_date AS DATE), region"""


STORES = f"""stores AS (
  SELECT md5(coalesce(store_id, '_dbt_utils_surrogate_key_null_')) AS store_key, store_id, region,
    min(sale_date) AS first_sale_date, max(sale_date) AS last_sale_date, count(*) AS total_transactions,
    count(DISTINCT customer_id) AS unique_customers, {money('sum(total_amount)')} AS total_revenue,
    {average('total_amount')} AS avg_order_value, {AS_OF} AS _loaded_at
  FROM fact GROUP BY store_id, region)"""

# --- change events ----------------------------------------------------------
LOG = """log AS (
  SELECT event_id, ts, user_id AS sale_id, CAST(props->>'$.k' AS INTEGER) AS k,
    CASE event_type WHEN 'signup' THEN 'r' WHEN 'view' THEN 'c' WHEN 'click' THEN 'u' WHEN 'purchase' THEN 'u'
      WHEN 'error' THEN 'd' END AS op,
    CAST(value AS DECIMAL(10,2)) AS price, date_trunc('milliseconds', ts) AS ms,
    list_extract(['US-EAST', 'US-WEST', 'EUROPE', 'ASIA-PACIFIC'], CAST(user_id % 4 + 1 AS INTEGER)) AS region
  FROM events)"""
# Records no parser accepts: the events that have one, how many steps of 10^12 its offset lies ahead, the reason.
REJECTED = (
    ("event_id % 17 = 0", 3, "unreadable"),
    ("event_id % 19 = 0", 4, "unreadable"),
    ("event_id % 23 = 0 AND op <> 'd'", 5, "bad_amount"),
    ("event_id % 29 = 0", 6, "bad_timestamp"),
    ("event_id % 31 = 0", 7, "no_key"),
    ("event_id % 37 = 0", 8, "unknown_operation"),
)
REJECTED_COUNT = " + ".join(f"count(*) FILTER (WHERE {affected})" for affected, _, _ in REJECTED)
REJECTED_NEWEST = ", ".join(f"max(event_id + {step}000000000000) FILTER (WHERE {affected})" for affected, step, _ in REJECTED)
REJECTED_ROWS = " UNION ALL ".join(
    f"SELECT event_id + {step}000000000000 AS _kafka_offset, '{reason}' AS rejection_reason FROM log WHERE {affected}"
    for affected, step, reason in REJECTED
)
DELIVERED = """delivered AS (
  SELECT *, event_id AS _kafka_offset FROM log
  UNION ALL SELECT *, event_id FROM log WHERE event_id % 10 = 0
  UNION ALL SELECT *, event_id + 1000000000000 FROM log WHERE event_id % 9 = 0)"""
PARSED = f"""parsed AS (
  SELECT sale_id,
    CASE WHEN op <> 'd' THEN 'C' || sale_id END AS customer_id, CASE WHEN op <> 'd' THEN 'P' || k END AS product_id,
    CASE WHEN op <> 'd' THEN CAST(date_trunc('day', ts) AS TIMESTAMP) END AS sale_date,
    CASE WHEN op <> 'd' THEN CAST(k % 7 AS INTEGER) END AS quantity, CASE WHEN op <> 'd' THEN price END AS unit_price,
    CASE WHEN op <> 'd' THEN total END AS total_amount, region,
    CASE WHEN op <> 'd' THEN 'S' || (sale_id % 20) END AS store_id,
    CASE WHEN op <> 'd' THEN list_extract(['credit', 'cash', 'debit'], k % 3 + 1) END AS payment_method,
    disc AS discount_amount, tax AS tax_amount,
    CAST(CASE WHEN op <> 'd' THEN total ELSE 0 END - disc AS DECIMAL(10,2)) AS net_amount,
    CAST(CASE WHEN op <> 'd' THEN total ELSE 0 END - disc - tax AS DECIMAL(10,2)) AS gross_profit,
    CASE WHEN op <> 'd' THEN CAST(year(ts) AS INTEGER) END AS sale_year,
    CASE WHEN op <> 'd' THEN CAST(month(ts) AS INTEGER) END AS sale_month,
    CASE WHEN op <> 'd' THEN CAST(day(ts) AS INTEGER) END AS sale_day,
    CASE WHEN op <> 'd' THEN TIMESTAMP '2023-12-31 00:00:00' + to_seconds(sale_id) END AS created_at,
    ms AS updated_at, (op = 'd' OR k % 11 = 0) AS is_deleted, {EVENTS_AS_OF} AS etl_loaded_at,
    '20240301' AS etl_batch_id, op AS _cdc_operation, ms AS _cdc_source_ts, _kafka_offset
  FROM (SELECT *, CAST(price * (k % 7) AS DECIMAL(10,2)) AS total,
      CASE WHEN op <> 'd' AND k % 4 <> 0 THEN CAST(k * CAST(0.01 AS DECIMAL(3,2)) AS DECIMAL(10,2))
        ELSE CAST(0 AS DECIMAL(10,2)) END AS disc,
      CASE WHEN op <> 'd' AND k % 5 <> 0 THEN CAST(k * CAST(0.005 AS DECIMAL(4,3)) AS DECIMAL(10,2))
        ELSE CAST(0 AS DECIMAL(10,2)) END AS tax
    FROM delivered) priced
  WHERE op = 'd' OR k % 13 <> 0)"""
LATEST_EVENT = f"""latest_event AS (
  SELECT * EXCLUDE (rn) FROM (
    SELECT *, row_number() OVER (PARTITION BY sale_id
      ORDER BY _cdc_source_ts DESC NULLS LAST, _kafka_offset DESC NULLS LAST, is_deleted DESC NULLS LAST, {CONTENT}) AS rn
    FROM parsed) ranked WHERE rn = 1)"""

def _parts(kept: str) -> dict[str, str]:
    return {
        "sales": SALES,
        **chain("", "true", AS_OF, kept),
        **chain("old_", f"updated_at < {CUT}", CUT, kept),
        **chain("new_", f"updated_at >= {CUT}", AS_OF, kept),
        "changes": changes(kept),
        "actions": ACTIONS,
        "merged": MERGED,
        "daily": f"daily AS ({daily('fact')})",
        "old_daily": f"old_daily AS ({daily('old_fact')})",
        "stores": STORES,
        "log": LOG,
        "delivered": DELIVERED,
        "parsed": PARSED,
        "latest_event": LATEST_EVENT,
    }


# Without and with the condition that a sale is completed.
_PARTS = {False: _parts(""), True: _parts("status = 'completed' AND ")}
_NEEDS: dict[str, list[str]] = {
    "staged": ["sales"],
    "checked": ["staged"],
    "fact": ["checked"],
    "old_staged": ["sales"],
    "old_checked": ["old_staged"],
    "old_fact": ["old_checked"],
    "new_staged": ["sales"],
    "new_checked": ["new_staged"],
    "new_fact": ["new_checked"],
    "changes": ["new_checked"],
    "actions": ["old_fact", "changes"],
    "merged": ["actions"],
    "daily": ["fact"],
    "old_daily": ["old_fact"],
    "stores": ["fact"],
    "delivered": ["log"],
    "parsed": ["delivered"],
    "latest_event": ["parsed"],
}


def sql(needs: str, statement: str, completed_only: bool = False) -> str:
    """The statement with everything it needs in front; ``needs`` is space separated.

    With ``completed_only`` the models take the rows of completed sales alone.
    """
    ordered: list[str] = []

    def visit(name: str) -> None:
        for other in _NEEDS.get(name, []):
            visit(other)
        if name not in ordered:
            ordered.append(name)

    for name in needs.split():
        visit(name)
    return "WITH " + ",\n".join(_PARTS[completed_only][name] for name in ordered) + "\n" + statement

"""SQL for the registered queries, in DuckDB's dialect, over the same test tables."""

from __future__ import annotations

_TX = """
  SELECT 'T' || l_orderkey || '-' || l_linenumber AS transaction_id,
         CAST(CAST(CAST(round(l_extendedprice * 100) AS BIGINT) // 10 AS DECIMAL(18,0)) * 0.01 AS DECIMAL(18,2))
           AS amount,
         CASE l_returnflag WHEN 'A' THEN 'CNY' WHEN 'N' THEN 'USD' ELSE 'EUR' END AS currency,
         'C' || o_custkey AS customer_id, 'A' || o_custkey || '-' || (l_linenumber % 5) AS account_id,
         'M' || l_suppkey AS merchant_id,
         CASE l_linestatus WHEN 'F' THEN 'REFUND' ELSE 'PAYMENT' END AS transaction_type,
         CAST(DATE '2026-08-01' + CAST(datediff('day', DATE '1995-01-02', CAST(l_shipdate AS DATE)) % 61 AS INTEGER)
              AS TIMESTAMP) + to_seconds((l_orderkey * 37 + l_linenumber * 61) % 86400) AS event_time,
         l_linenumber, l_quantity, l_tax
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey"""
_DIRTY = """
  SELECT CASE WHEN l_quantity <> 50 THEN transaction_id END AS transaction_id,
         CASE WHEN l_linenumber = 7 THEN -amount ELSE amount END AS amount,
         CASE WHEN l_quantity = 13 THEN 'GBP' ELSE currency END AS currency, customer_id, account_id, merchant_id,
         CASE WHEN l_quantity = 17 THEN 'CHARGEBACK' ELSE transaction_type END AS transaction_type, CASE WHEN l_tax <> 0.08 THEN event_time END AS event_time FROM tx"""
_CLEAN = """
  SELECT * FROM dirty WHERE transaction_id IS NOT NULL AND amount > 0 AND event_time IS NOT NULL"""
_CUST = """
  SELECT c_custkey AS n, 'C' || c_custkey AS customer_id, 'V' || (1 + c_custkey % 4) AS level, n_name AS region,
         TIMESTAMP '2025-01-01' + to_hours(c_custkey) AS register_time,
         CASE WHEN c_acctbal < 0 THEN 'DELETED' ELSE 'ACTIVE' END AS status
  FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey"""
_MERCH = """
  SELECT s_suppkey AS n, 'M' || s_suppkey AS merchant_id, 'K' || (s_suppkey % 7) AS category, n_name AS region,
         CASE WHEN s_acctbal < 2000 THEN 'HIGH' WHEN s_acctbal < 6000 THEN 'MEDIUM' ELSE 'LOW' END AS risk_level,
         CASE WHEN s_acctbal < 0 THEN 'DELETED' ELSE 'ACTIVE' END AS status
  FROM supplier LEFT JOIN nation ON s_nationkey = n_nationkey"""
_DWD = """
  SELECT t.*, CAST(t.event_time AS DATE) AS dt, c.level AS customer_level, c.region AS customer_region,
         c.register_time AS customer_register_time, m.category AS merchant_category, m.region AS merchant_region,
         m.risk_level AS merchant_risk_level
  FROM clean t LEFT JOIN (SELECT * FROM cust WHERE n % 20 <> 0) c ON t.customer_id = c.customer_id
       LEFT JOIN merch m ON t.merchant_id = m.merchant_id"""
# Money is carried as whole cents so that ratios can be rounded half up in exact integers
_CD = """
  SELECT customer_id, dt, count(*) AS n, CAST(sum(amount) * 100 AS BIGINT) AS cents,
         count(*) FILTER (transaction_type = 'PAYMENT') AS pay_n,
         CAST(sum(CASE WHEN transaction_type = 'PAYMENT' THEN amount ELSE 0 END) * 100 AS BIGINT) AS pay_cents,
         count(*) FILTER (transaction_type = 'REFUND') AS refund_n,
         CAST(sum(CASE WHEN transaction_type = 'REFUND' THEN amount ELSE 0 END) * 100 AS BIGINT) AS refund_cents
  FROM dwd GROUP BY customer_id, dt"""


def _cents_if(condition: str) -> str:
    return f"CAST(sum(CASE WHEN {condition} THEN amount END) * 100 AS BIGINT)"


_MD = f"""
  SELECT merchant_id, dt, count(*) AS n, count(DISTINCT customer_id) AS customer_count,
         count(DISTINCT account_id) AS account_count, CAST(sum(amount) * 100 AS BIGINT) AS cents,
         CAST(max(amount) * 100 AS BIGINT) AS max_cents,
         count(*) FILTER (transaction_type = 'PAYMENT') AS pay_n,
         {_cents_if("transaction_type = 'PAYMENT'")} AS pay_cents,
         count(*) FILTER (transaction_type = 'REFUND') AS refund_n,
         {_cents_if("transaction_type = 'REFUND'")} AS refund_cents,
         count(DISTINCT currency) AS currency_count, {_cents_if("currency = 'CNY'")} AS cny_cents,
         {_cents_if("currency = 'USD'")} AS usd_cents, {_cents_if("currency = 'EUR'")} AS eur_cents,
         count(*) FILTER (merchant_risk_level = 'HIGH') AS high_n,
         count(DISTINCT CASE WHEN merchant_risk_level = 'HIGH' THEN customer_id END) AS high_customers
  FROM dwd GROUP BY merchant_id, dt"""
_EV = """
  SELECT event_id AS n, 'T' || event_id AS transaction_id,
         make_timestamp(1788480000000000 + (epoch_us(ts) - 1704067200000000) // 100) AS event_time,
         'C' || (user_id % 20) AS customer_id, 'A' || user_id AS account_id,
         'M' || (props ->> '$.k') AS merchant_id,
         CAST(CAST(round(value * 100) AS BIGINT) AS DECIMAL(18,2)) AS amount,
         CASE event_id % 3 WHEN 0 THEN 'CNY' WHEN 1 THEN 'USD' ELSE 'EUR' END AS currency,
         CASE WHEN event_type IN ('purchase', 'view', 'click') THEN 'PAYMENT' ELSE 'REFUND' END
           AS transaction_type FROM events"""
_ONLINE = """
  SELECT e.transaction_id, date_trunc('millisecond', e.event_time) AS event_time, e.customer_id, e.account_id,
         e.merchant_id, e.amount, e.currency, e.transaction_type, c.level AS customer_level,
         c.region AS customer_region, CAST(c.register_time AS VARCHAR) AS customer_register_time,
         m.category AS merchant_category, m.risk_level AS merchant_risk_level
  FROM ev e LEFT JOIN (SELECT * FROM cust WHERE n % 20 <> 0) c ON e.customer_id = c.customer_id
       LEFT JOIN merch m ON e.merchant_id = m.merchant_id
  WHERE e.n % 11 NOT IN (0, 1) AND e.amount > 0"""
# Every row of the stream, as the window queries read it
_LIVE = """
  SELECT e.*, m.risk_level AS merchant_risk_level FROM ev e LEFT JOIN merch m ON e.merchant_id = m.merchant_id
  WHERE e.amount > 0"""

_CTES = {"tx": _TX, "dirty": _DIRTY, "clean": _CLEAN, "cust": _CUST, "merch": _MERCH, "dwd": _DWD, "cd": _CD,
         "md": _MD, "ev": _EV, "online": _ONLINE, "live": _LIVE}
_NEEDS = {"dirty": ["tx"], "clean": ["tx", "dirty"], "dwd": ["tx", "dirty", "clean", "cust", "merch"],
          "online": ["ev", "cust", "merch"], "live": ["ev", "merch"]}
_NEEDS["cd"] = _NEEDS["md"] = [*_NEEDS["dwd"], "dwd"]


def _with(parts: list[str], body: str) -> str:
    wanted = []
    for part in parts:
        wanted += [*_NEEDS.get(part, []), part]
    ctes = [f"{name} AS ({text})" for name, text in _CTES.items() if name in wanted]
    return f"WITH {', '.join(ctes)}\n{body}"


def _day(column: str) -> str:
    return f"strftime({column}, '%Y-%m-%d')"


def _time(column: str) -> str:
    return f"strftime({column}, '%Y-%m-%d %H:%M:%S.%f')"


def _money(column: str) -> str:
    return f"CAST({column} AS DOUBLE)"


def _from_cents(column: str) -> str:
    return f"CAST({column} AS DOUBLE) / 100"


def _rounded(numerator: str, denominator: str, scale: int) -> str:
    """numerator / denominator rounded half up to 1/scale, in whole numbers until the last step."""
    return (f"CAST((2 * ({numerator}) * {scale} + ({denominator})) // (2 * ({denominator})) AS DOUBLE) / {scale}")


_TX_COLUMNS = f"""transaction_id, {_money('amount')} AS amount, currency, customer_id, account_id, merchant_id,
  transaction_type, {_time('event_time')} AS event_time"""

_PROFILE = f"""
  SELECT customer_id, dt, n AS txn_count, cents, pay_n AS pay_count, pay_cents, refund_n AS refund_count,
         refund_cents, {_rounded('cents', '100 * n', 100)} AS avg_ticket_amount,
         {_rounded('refund_n', 'n', 10000)} AS refund_txn_rate,
         {_rounded('pay_cents', 'cents', 10000)} AS pay_amount_ratio, refund_n > 0 AS has_refund,
         CASE WHEN cents >= 1000000 THEN 'HIGH' WHEN cents >= 100000 THEN 'MID' ELSE 'LOW' END AS amount_tier,
         {_rounded('sum(cents) OVER w7', '100 * count(*) OVER w7', 100)} AS ma7_total_amount,
         CAST(sum(n) OVER w7 AS DOUBLE) / count(*) OVER w7 AS ma7_txn_count,
         CAST(cents - lag(cents) OVER w AS DOUBLE) / 100 AS dod_amount_change
  FROM cd WINDOW w AS (PARTITION BY customer_id ORDER BY dt),
       w7 AS (PARTITION BY customer_id ORDER BY dt ROWS BETWEEN 6 PRECEDING AND CURRENT ROW)"""

_PROFILE_API = f"""customer_id, {_day('dt')} AS dt, txn_count, {_from_cents('cents')} AS total_amount,
  avg_ticket_amount, refund_txn_rate, has_refund, amount_tier, ma7_total_amount, ma7_txn_count, dod_amount_change"""


def _windows(kind: str, size: int, source: str) -> str:
    """Windows of ``size`` minutes every five, closed by the last watermark."""
    starts = ", ".join(f"time_bucket(INTERVAL '5 minutes', event_time) - to_minutes({back})"
                       for back in range(0, size, 5))
    return f"""
  SELECT '{kind}' AS window_type, {_time('window_start')} AS window_start, {_time('window_end')} AS window_end,
         customer_id, {_money('sum(amount)')} AS total_amount,
         CAST(CAST(sum(amount) AS DECIMAL(18,2)) AS DOUBLE) / count(amount) AS avg_amount,
         {_money('max(amount)')} AS max_amount, {_money('min(amount)')} AS min_amount,
         count(DISTINCT transaction_id) AS transaction_count, count(DISTINCT merchant_id) AS merchant_count,
         count(DISTINCT account_id) AS account_count, count(DISTINCT currency) AS currency_count,
         count(DISTINCT transaction_type) AS txn_type_count,
         count(*) FILTER (merchant_risk_level = 'HIGH') AS high_risk_txn_count,
         {_money('sum(CASE WHEN amount > 10000 THEN amount ELSE 0 END)')} AS large_txn_amount,
         {_time('min(event_time)')} AS first_txn_time, {_time('max(event_time)')} AS last_txn_time
  FROM (SELECT *, window_start + to_minutes({size}) AS window_end
        FROM (SELECT *, unnest([{starts}]) AS window_start FROM {source}))
  WHERE window_end <= (SELECT date_trunc('millisecond', max(event_time)) - to_seconds(5) FROM {source})
  GROUP BY window_start, window_end, customer_id"""


# A day's changes to the customers: new ids continue the highest one in the order of the hash of the reference
_EVOLVED_CUSTOMERS = """
  SELECT customer_id, CASE WHEN status = 'ACTIVE' AND n % 10 = 3 THEN 'V4' ELSE level END AS level,
         CASE WHEN status = 'ACTIVE' AND n % 10 = 3 THEN 'MOVED' ELSE region END AS region, register_time,
         CASE WHEN n % 10 = 5 THEN 'DELETED' ELSE status END AS status
  FROM cust WHERE n % 20 <> 0
  UNION ALL
  SELECT 'C' || ((SELECT max(n) FROM cust WHERE n % 20 <> 0)
                 + row_number() OVER (ORDER BY substr(md5(customer_id), 1, 3), customer_id)),
         level, region, register_time, 'ACTIVE'
  FROM cust WHERE n % 20 = 0"""
_EVOLVED_MERCHANTS = """
  SELECT merchant_id, category, region, CASE WHEN n % 10 = 5 THEN 'DELETED' ELSE status END AS status,
         CASE WHEN status = 'ACTIVE' AND n % 10 = 3 THEN 'HIGH' ELSE risk_level END AS risk_level FROM merch
  UNION ALL
  SELECT 'M' || ((SELECT max(n) FROM merch)
                 + row_number() OVER (ORDER BY substr(md5('new-' || merchant_id), 1, 3), 'new-' || merchant_id)),
         category, region, 'ACTIVE', risk_level
  FROM merch"""
_ACCOUNTS = """
  SELECT n, slot, 'A' || n || '-' || slot AS account_id, customer_id,
         CASE slot % 3 WHEN 0 THEN 'SAVINGS' WHEN 1 THEN 'CHECKING' ELSE 'CREDIT' END AS account_type,
         register_time + to_hours(slot + 1) AS open_time
  FROM cust, (SELECT unnest(range(5)) AS slot)"""
_EVOLVED_ACCOUNTS = f"""
  SELECT account_id, account_type, open_time, customer_id FROM ({_ACCOUNTS}) WHERE n % 20 <> 0
  UNION ALL
  SELECT 'A' || (10000 + row_number() OVER (ORDER BY substr(md5(account_id), 1, 3), account_id)), account_type, open_time,
         new_id
  FROM ({_ACCOUNTS}) a JOIN (
    SELECT customer_id, 'C' || ((SELECT max(n) FROM cust WHERE n % 20 <> 0)
             + row_number() OVER (ORDER BY substr(md5(customer_id), 1, 3), customer_id)) AS new_id
    FROM cust WHERE n % 20 = 0) c USING (customer_id)"""

# Customers as they arrive: blank ids, missing levels and unreadable times
_TEXT_CUSTOMERS = """
  SELECT CASE WHEN n % 50 = 7 THEN '' ELSE customer_id END AS customer_id,
         CASE WHEN n % 50 = 17 THEN 'V9' WHEN n % 50 <> 11 THEN level END AS level, region,
         CASE WHEN n % 50 <> 13 THEN register_time END AS register_time,
         CASE WHEN n % 50 = 19 THEN 'GONE' ELSE status END AS status FROM cust"""


def _measures(table: str, source: str, measures: dict[str, str]) -> str:
    return " UNION ALL ".join(
        f"SELECT '{table}' AS table_name, '{name}' AS measure, CAST({value} AS DOUBLE) AS value FROM {source}"
        for name, value in measures.items())


_QUALITY = " UNION ALL ".join([
    _measures("ods_transaction", "dirty", {
        "row_count": "count(*)", "missing_transaction_id": "count(*) FILTER (transaction_id IS NULL)",
        "amount_not_positive": "count(*) FILTER (amount IS NULL OR amount <= 0)"}),
    _measures("dwd_transaction", "dwd", {
        "row_count": "count(*)", "missing_transaction_id": "count(*) FILTER (transaction_id IS NULL)",
        "amount_not_positive": "count(*) FILTER (amount IS NULL OR amount <= 0)"}),
    _measures("dws_customer_daily", "cd", {"row_count": "count(*)",
                                           "negative_amount": "count(*) FILTER (cents < 0)"}),
    _measures("ods_customer", f"({_TEXT_CUSTOMERS})", {
        "row_count": "count(*)", "bad_register_time": "count(*) FILTER (register_time IS NULL)",
        "bad_level": "count(*) FILTER (level NOT IN ('V1', 'V2', 'V3', 'V4'))",
        "bad_status": "count(*) FILTER (status NOT IN ('ACTIVE', 'DELETED'))"}),
    _measures("ods_merchant", "merch", {
        "row_count": "count(*)", "bad_risk_level": "count(*) FILTER (risk_level NOT IN ('LOW', 'MEDIUM', 'HIGH'))",
        "bad_status": "count(*) FILTER (status NOT IN ('ACTIVE', 'DELETED'))"}),
    _measures("dwd_null_rate", "dwd", {
        "customer_level_null_rate": "CAST(count(*) FILTER (customer_level IS NULL) AS DOUBLE) / count(*)",
        "merchant_category_null_rate": "CAST(count(*) FILTER (merchant_category IS NULL) AS DOUBLE) / count(*)"}),
    _measures("dwd_orphans", "(SELECT * FROM dwd WHERE customer_level IS NULL)", {
        "orphan_customers": "count(DISTINCT customer_id)", "orphan_rows": "count(*)"}),
])

_TURN = ("least(2, CAST(floor(epoch(date_trunc('second', event_time)) % 86400 / 8640) AS INTEGER) "
         "+ CASE WHEN n % 10 = 9 THEN 1 ELSE 0 END)")

ORACLE: dict[str, str] = {
    "ods_transaction": _with(["dirty"], f"""
SELECT {_TX_COLUMNS}, {_day('event_time')} AS dt FROM dirty"""),

    "ods_day_scan": _with(["tx"], f"""
SELECT {_day('event_time')} AS dt, count(*) AS txn_count, {_money('sum(amount)')} AS total_amount, scan
FROM tx JOIN (VALUES ('source_day', DATE '2026-09-04'), ('day', DATE '2026-09-04'), ('week', DATE '2026-08-29'),
                     ('month', DATE '2026-08-31')) s(scan, first_day)
  ON CAST(event_time AS DATE) BETWEEN first_day AND DATE '2026-09-04'
GROUP BY ALL"""),

    "dim_customer": _with(["cust"], f"""
SELECT customer_id, level, region, {_time('register_time')} AS register_time, status FROM ({_TEXT_CUSTOMERS})
WHERE customer_id <> '' AND level IS NOT NULL AND register_time IS NOT NULL"""),

    "dim_merchant": _with(["merch"], "SELECT merchant_id, category, region, risk_level, status FROM merch"),

    "dwd_clean": _with(["clean"], f"SELECT {_TX_COLUMNS}, {_day('event_time')} AS dt FROM clean"),

    "dwd_transaction": _with(["dwd"], f"""
SELECT {_TX_COLUMNS}, {_day('dt')} AS dt, customer_level, customer_region,
  {_time('customer_register_time')} AS customer_register_time, merchant_category, merchant_region,
  merchant_risk_level FROM dwd"""),

    "dws_customer_daily": _with(["cd"], f"""
SELECT {_day('dt')} AS dt, customer_id, n AS txn_count, {_from_cents('cents')} AS total_amount,
  {_from_cents('cents')} / n AS avg_amount, pay_n AS pay_count, {_from_cents('pay_cents')} AS pay_amount,
  refund_n AS refund_count, {_from_cents('refund_cents')} AS refund_amount FROM cd"""),

    "dws_merchant_daily": _with(["md"], f"""
SELECT {_day('dt')} AS dt, merchant_id, n AS txn_count, customer_count, account_count,
  {_from_cents('cents')} AS total_amount, {_from_cents('cents')} / n AS avg_amount,
  {_from_cents('max_cents')} AS max_amount, pay_n AS pay_count, {_from_cents('pay_cents')} AS pay_amount,
  refund_n AS refund_count, {_from_cents('refund_cents')} AS refund_amount, currency_count,
  {_from_cents('cny_cents')} AS cny_amount, {_from_cents('usd_cents')} AS usd_amount,
  {_from_cents('eur_cents')} AS eur_amount, high_n AS high_risk_txn_count,
  high_customers AS high_risk_customer_count, {_rounded('refund_n', 'n', 10000)} AS refund_rate FROM md"""),

    "ads_customer_profile": _with(["cd"], f"""
SELECT {_day('dt')} AS dt, customer_id, txn_count, {_from_cents('cents')} AS total_amount, pay_count,
  {_from_cents('pay_cents')} AS pay_amount, refund_count, {_from_cents('refund_cents')} AS refund_amount,
  avg_ticket_amount, refund_txn_rate, pay_amount_ratio, has_refund, amount_tier, ma7_total_amount, ma7_txn_count,
  dod_amount_change FROM ({_PROFILE})"""),

    "ads_daily_report": _with(["md"], f"""
, daily AS (
  SELECT dt, strftime(dt, '%Y-%m') AS month, count(*) AS active_merchant_count, CAST(sum(n) AS BIGINT) AS n,
    CAST(sum(cents) AS BIGINT) AS cents, CAST(sum(pay_n) AS BIGINT) AS pay_count,
    CAST(sum(pay_cents) AS BIGINT) AS pay_cents, CAST(sum(refund_n) AS BIGINT) AS refund_n,
    CAST(sum(refund_cents) AS BIGINT) AS refund_cents, CAST(sum(cny_cents) AS BIGINT) AS cny_cents,
    CAST(sum(usd_cents) AS BIGINT) AS usd_cents, CAST(sum(eur_cents) AS BIGINT) AS eur_cents,
    CAST(sum(high_n) AS BIGINT) AS high_n, max(max_cents) AS max_cents FROM md GROUP BY dt),
rated AS (SELECT *, (2 * refund_n * 10000 + n) // (2 * n) AS rate FROM daily)
SELECT {_day('dt')} AS dt, month, active_merchant_count, n AS total_txn_count,
  {_from_cents('cents')} AS total_amount, pay_count, {_from_cents('pay_cents')} AS pay_amount,
  refund_n AS refund_count, {_from_cents('refund_cents')} AS refund_amount, {_from_cents('cny_cents')} AS cny_amount,
  {_from_cents('usd_cents')} AS usd_amount, {_from_cents('eur_cents')} AS eur_amount,
  high_n AS high_risk_txn_count, {_from_cents('max_cents')} AS max_amount,
  {_rounded('cents', '100 * n', 100)} AS avg_ticket_amount, CAST(rate AS DOUBLE) / 10000 AS refund_rate,
  {_rounded('high_n', 'n', 10000)} AS high_risk_txn_ratio,
  CAST(lag(rate) OVER (ORDER BY dt) AS DOUBLE) / 10000 AS prev_refund_rate,
  CAST(rate - lag(rate) OVER (ORDER BY dt) AS DOUBLE) / 10000 AS refund_rate_diff,
  CAST(sum(n) OVER m AS BIGINT) AS month_total_txn_count,
  CAST(CAST(sum(cents) OVER m AS BIGINT) AS DOUBLE) / 100 AS month_total_amount
FROM rated WINDOW m AS (PARTITION BY month ORDER BY dt ROWS UNBOUNDED PRECEDING)"""),

    "ads_merchant_top10": _with(["md"], f"""
SELECT {_day('dt')} AS dt, CAST(rank_no AS INTEGER) AS rank_no, merchant_id, n AS txn_count, customer_count,
  {_from_cents('cents')} AS total_amount, {_rounded('cents', 'day_cents', 10000)} AS amount_share
FROM (SELECT *, CAST(sum(cents) OVER (PARTITION BY dt) AS BIGINT) AS day_cents,
        row_number() OVER (PARTITION BY dt ORDER BY cents DESC, n DESC, merchant_id) AS rank_no FROM md)
WHERE rank_no <= 10"""),

    "recent_transactions": _with(["clean"], f"""
SELECT * FROM (SELECT {_TX_COLUMNS} FROM clean) ORDER BY event_time DESC, transaction_id, customer_id, account_id,
  merchant_id, amount, currency, transaction_type LIMIT 20"""),

    "customer_stats": _with(["clean"], f"""
SELECT customer_id, transaction_type, {_money('sum(amount)')} AS amount_sum, count(*) AS transaction_count
FROM clean GROUP BY customer_id, transaction_type"""),

    "latest_profile": _with(["cd"], f"""
SELECT {_PROFILE_API}
FROM (SELECT *, row_number() OVER (PARTITION BY customer_id ORDER BY dt DESC) AS r FROM ({_PROFILE})) WHERE r = 1"""),

    "full_profile": _with(["cd"], f"""
, stats AS (SELECT customer_id, transaction_type, {_money('sum(amount)')} AS amount_sum,
    count(*) AS transaction_count FROM clean GROUP BY customer_id, transaction_type),
newest AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY customer_id ORDER BY dt DESC) AS r
    FROM ({_PROFILE})) WHERE r = 1)
SELECT coalesce(s.customer_id, p.customer_id) AS customer_id, transaction_type, amount_sum, transaction_count,
  {_day('p.dt')} AS dt, txn_count, {_from_cents('p.cents')} AS total_amount, avg_ticket_amount, refund_txn_rate,
  has_refund, amount_tier, ma7_total_amount, ma7_txn_count, dod_amount_change
FROM stats s FULL JOIN newest p ON s.customer_id = p.customer_id"""),

    "one_customer_profile": _with(["cd"], f"""
, stats AS (SELECT customer_id, transaction_type, {_money('sum(amount)')} AS amount_sum,
    count(*) AS transaction_count FROM clean GROUP BY customer_id, transaction_type),
newest AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY customer_id ORDER BY dt DESC) AS r
    FROM ({_PROFILE})) WHERE r = 1)
SELECT coalesce(s.customer_id, p.customer_id) AS customer_id, transaction_type, amount_sum, transaction_count,
  {_day('p.dt')} AS dt, txn_count, {_from_cents('p.cents')} AS total_amount, avg_ticket_amount, refund_txn_rate,
  has_refund, amount_tier, ma7_total_amount, ma7_txn_count, dod_amount_change
FROM stats s FULL JOIN newest p ON s.customer_id = p.customer_id
WHERE coalesce(s.customer_id, p.customer_id) = 'C7'"""),

    # of rows alike in the whole key the table keeps one, the greatest by its other columns
    "one_customer_recent": _with(["clean"], f"""
SELECT * FROM (SELECT {_TX_COLUMNS} FROM clean WHERE customer_id = 'C7'
  QUALIFY row_number() OVER (PARTITION BY transaction_id, event_time ORDER BY amount DESC, currency DESC, account_id DESC,
    merchant_id DESC, transaction_type DESC) = 1) ORDER BY event_time DESC, transaction_id, customer_id, account_id,
  merchant_id, amount, currency, transaction_type LIMIT 20"""),

    "day_replace_rerun": _with(["tx"], f"""
SELECT {_day('event_time')} AS dt, count(*) AS txn_count, {_money('sum(amount)')} AS total_amount FROM tx
WHERE CAST(event_time AS DATE) <> DATE '2026-08-15' GROUP BY 1"""),

    "dim_evolve": _with(["cust"], f"""
SELECT customer_id, level, region, {_time('register_time')} AS register_time, status
FROM ({_EVOLVED_CUSTOMERS})"""),

    "dim_refused_changes": _with(["cust"], """
, named AS (
  SELECT 'updates' AS change, customer_id AS id, status FROM cust WHERE n % 10 = 0
  UNION ALL SELECT 'updates', customer_id, status FROM cust WHERE n % 30 = 0
  UNION ALL SELECT 'updates', customer_id || '0000000', 'DELETED' FROM cust WHERE n % 17 = 0
  UNION ALL SELECT 'deletes', customer_id, status FROM cust WHERE n % 7 = 0
  UNION ALL SELECT 'adds', CASE WHEN n % 80 <> 0 THEN customer_id END, 'ACTIVE' FROM cust WHERE n % 40 = 0),
judged AS (
  SELECT change, id, CASE WHEN id IS NULL THEN 'missing' WHEN count(*) > 1 THEN 'repeated'
    WHEN any_value(status) = 'DELETED' THEN 'not active' END AS reason FROM named GROUP BY change, id)
SELECT * FROM judged WHERE reason IS NOT NULL"""),

    "dim_snapshot_rerun": _with(["cust", "merch"], f"""
SELECT customer_id AS id, level AS kind, region, status, {_time('register_time')} AS since, NULL AS extra
FROM ({_EVOLVED_CUSTOMERS})
UNION ALL SELECT merchant_id, category, region, status, NULL, risk_level FROM ({_EVOLVED_MERCHANTS})
UNION ALL SELECT account_id, account_type, NULL, NULL, {_time('open_time')}, customer_id FROM ({_EVOLVED_ACCOUNTS})"""),

    "dim_repeated_keys": _with(["tx", "cust", "merch"], f"""
, c AS (SELECT n, customer_id, CASE WHEN n % 3 = 0 THEN 'V4' ELSE level END AS level,
               CASE WHEN n % 5 = 0 AND n % 3 <> 0 THEN 'DELETED' ELSE status END AS status,
               CASE WHEN n % 3 = 0 THEN register_time + INTERVAL 1 DAY ELSE register_time END AS register_time FROM cust),
  m AS (SELECT merchant_id, category, CASE WHEN n % 5 = 0 THEN 'DELETED' ELSE status END AS status FROM merch)
SELECT 'dim_customer' AS table_name, customer_id AS id, level AS kind, status, {_time('register_time')} AS since FROM c
UNION ALL SELECT 'dim_merchant', merchant_id, category, status, NULL FROM m
UNION ALL SELECT 'lookup_customer', 'dim:customer:' || customer_id, level, status, NULL FROM c
UNION ALL SELECT 'dwd_transaction', t.transaction_id, c.level, m.category, {_time('c.register_time')}
FROM tx t LEFT JOIN c USING (customer_id) LEFT JOIN m USING (merchant_id)
WHERE CAST(t.event_time AS DATE) = DATE '2026-09-04' AND t.amount > 0
"""),
    "warehouse_days": _with(["tx", "cust", "merch"], f"""
, days AS (SELECT *, CAST(event_time AS DATE) AS dt FROM tx
    WHERE CAST(event_time AS DATE) BETWEEN DATE '2026-09-03' AND DATE '2026-09-04'),
by_customer AS (SELECT dt, customer_id, sum(amount) AS amount FROM days GROUP BY ALL),
by_merchant AS (SELECT dt, merchant_id, count(*) AS n, sum(amount) AS amount FROM days GROUP BY ALL),
totals AS (SELECT dt, sum(amount) AS amount FROM days GROUP BY dt),
average AS (SELECT dt, {_rounded('CAST(sum(100 * amount) OVER w AS BIGINT)', '100 * count(*) OVER w', 100)} AS amount
    FROM by_customer WINDOW w AS (PARTITION BY customer_id ORDER BY dt)),
top AS (SELECT *, row_number() OVER (PARTITION BY dt ORDER BY amount DESC, n DESC, merchant_id) AS r FROM by_merchant)
SELECT {_day('dt')} AS dt, count(*) AS row_count, {_money('sum(amount)')} AS amount, unnest(['ods_transaction', 'dwd_transaction'])
  AS table_name FROM days GROUP BY dt
UNION ALL SELECT {_day('dt')}, count(*), {_money('sum(amount)')}, 'dws_customer_daily' FROM by_customer GROUP BY dt
UNION ALL SELECT {_day('dt')}, count(*), {_money('sum(amount)')}, 'dws_merchant_daily' FROM by_merchant GROUP BY dt
UNION ALL SELECT {_day('dt')}, count(*), {_money('sum(CAST(amount AS DECIMAL(18,2)))')}, 'ads_customer_profile' FROM average GROUP BY dt
UNION ALL SELECT {_day('dt')}, 1, {_money('sum(amount) OVER (ORDER BY dt)')}, 'ads_daily_report' FROM totals
UNION ALL SELECT {_day('dt')}, count(*), {_money('sum(amount)')}, 'ads_merchant_top10' FROM top WHERE r <= 10 GROUP BY dt
UNION ALL SELECT NULL, count(*), NULL, unnest(['dim_customer', 'lookup_customer']) FROM cust
UNION ALL SELECT NULL, count(*), NULL, 'dim_merchant' FROM merch"""),

    "active_pool": _with(["cust", "merch"], f"""
SELECT 'account' AS kind, account_id AS id, customer_id AS owner, {_time('open_time')} AS open_time
FROM ({_ACCOUNTS}) JOIN (SELECT customer_id FROM cust WHERE status = 'ACTIVE') USING (customer_id)
UNION ALL SELECT 'customer', customer_id, NULL, NULL FROM cust WHERE status = 'ACTIVE'
UNION ALL SELECT 'merchant', merchant_id, NULL, NULL FROM merch WHERE status = 'ACTIVE'"""),

    "contract_quarantine": _with(["dirty"], f"""
SELECT {_TX_COLUMNS},
  CASE WHEN transaction_id IS NOT NULL AND event_time IS NOT NULL AND amount > 0
      AND currency IN ('CNY', 'USD', 'EUR') AND transaction_type IN ('PAYMENT', 'REFUND') THEN 'valid' ELSE
    concat_ws('; ', CASE WHEN transaction_id IS NULL THEN 'transaction_id missing' END,
                    CASE WHEN event_time IS NULL THEN 'event_time missing' END,
                    CASE WHEN amount <= 0 THEN 'amount not positive' END,
                    CASE WHEN currency NOT IN ('CNY', 'USD', 'EUR') THEN 'currency unknown' END,
                    CASE WHEN transaction_type NOT IN ('PAYMENT', 'REFUND') THEN 'transaction_type unknown' END) END
    AS verdict FROM dirty"""),

    "quality_report": _with(["cd", "merch", "cust"], _QUALITY),

    "status_default": _with(["cust"], """
SELECT customer_id, level, region, CASE WHEN n % 2 = 0 THEN 'ACTIVE' ELSE status END AS status FROM cust"""),

    "lookup_table": _with(["cust"], f"""
SELECT 'dim:customer:' || customer_id AS key, coalesce(level, '') AS level, coalesce(region, '') AS region,
  coalesce(CAST(register_time AS VARCHAR), '') AS register_time, coalesce(status, '') AS status,
  CAST(NULL AS VARCHAR) AS absent
FROM ({_TEXT_CUSTOMERS}) WHERE customer_id <> ''"""),

    "lookup_join": _with(["ev", "cust"], """
SELECT transaction_id, CAST(CASE WHEN c.customer_id IS NULL THEN 0 ELSE 4 END AS INTEGER) AS fields, c.level
FROM ev e LEFT JOIN (SELECT * FROM cust WHERE n % 20 <> 0) c ON e.customer_id = c.customer_id"""),

    "upsert_latest": _with(["tx"], f"""
SELECT {_TX_COLUMNS} FROM (SELECT *, row_number() OVER (PARTITION BY transaction_id
    ORDER BY CAST(epoch(event_time) AS BIGINT) % 3 DESC, amount DESC, currency DESC, customer_id DESC,
             account_id DESC, merchant_id DESC, transaction_type DESC, event_time DESC) AS r FROM tx)
WHERE r = 1"""),

    "topic_payload": _with(["ev"], """
SELECT '{"transaction_id":"' || transaction_id || '"}' AS key,
  '{"transaction_id":"' || transaction_id || '","event_time":"' || strftime(event_time, '%Y-%m-%dT%H:%M:%S.%gZ')
  || '","customer_id":"' || customer_id || '","account_id":"' || account_id || '","merchant_id":"' || merchant_id
  || '","amount":' || CAST(amount AS VARCHAR) || ',"currency":"' || currency || '","transaction_type":"'
  || transaction_type || '"}' AS value FROM ev"""),

    "json_parse_permissive": _with(["ev"], f"""
SELECT {_TX_COLUMNS} FROM (SELECT * REPLACE (date_trunc('millisecond', event_time) AS event_time) FROM ev)
WHERE n % 11 NOT IN (0, 1) AND amount > 0"""),

    "window_dedup": _with(["live"], _windows("TUMBLE", 5, "live")),
    "window_tumble": _with(["live"], _windows("TUMBLE", 5, "live")),
    "window_hop": _with(["live"], _windows("HOP", 10, "live")),
    "window_union": _with(["live"], _windows("TUMBLE", 5, "live") + " UNION ALL " + _windows("HOP", 10, "live")),
    "two_stage_windows": _with(["online"], _windows("TUMBLE", 5, "online") + " UNION ALL "
                               + _windows("HOP", 10, "online")),

    "stream_clean_enrich": _with(["online"], f"""
SELECT {_TX_COLUMNS}, customer_level, customer_region, customer_register_time, merchant_category,
  merchant_risk_level FROM online"""),

    "stream_dedup_latest": _with(["ev"], f"""
SELECT {_TX_COLUMNS} FROM (
  SELECT * REPLACE ('T' || (n // 3) AS transaction_id, date_trunc('millisecond', event_time) AS event_time),
    row_number() OVER (PARTITION BY n // 3 ORDER BY date_trunc('millisecond', event_time) DESC, amount DESC,
      currency DESC, customer_id DESC, account_id DESC, merchant_id DESC, transaction_type DESC) AS r FROM ev
  WHERE amount > 0) WHERE r = 1"""),

    "late_transactions": _with(["ev"], f"""
, turns AS (SELECT * REPLACE (date_trunc('millisecond', event_time) AS event_time), {_TURN} AS turn FROM ev)
SELECT {_TX_COLUMNS} FROM turns t
WHERE event_time < (SELECT max(event_time) FROM turns earlier WHERE earlier.turn < t.turn) - to_seconds(5)"""),

    "stream_one_scan": _with(["ev", "cust"], f"""
, turns AS (SELECT * REPLACE (date_trunc('millisecond', event_time) AS event_time), {_TURN} AS turn FROM ev)
SELECT 'online' AS sink, transaction_id, {_time('event_time')} AS event_time, {_money('amount')} AS amount, c.level AS customer_level
FROM turns t LEFT JOIN (SELECT * FROM cust WHERE n % 20 <> 0) c USING (customer_id) WHERE amount > 0
UNION ALL
SELECT 'late', transaction_id, {_time('event_time')}, {_money('amount')}, NULL FROM turns t
WHERE event_time < (SELECT max(event_time) FROM turns earlier WHERE earlier.turn < t.turn) - to_seconds(5)"""),
}

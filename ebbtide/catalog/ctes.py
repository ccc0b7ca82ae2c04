"""The same star-schema mapping as SQL text, for the independent checks."""

from __future__ import annotations

NUMBER = r"^[ ]*[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?[ ]*$"


def num(c: str) -> str:
    return f"CASE WHEN regexp_matches({c}, '{NUMBER}') THEN TRY_CAST(trim({c}) AS DOUBLE) END"


def h32(expr: str) -> str:
    return f"CAST('0x' || substr(md5(CAST({expr} AS VARCHAR)), 1, 8) AS BIGINT)"


ID = "unique_customer_identifier"
S = "DATE '1998-06-01'"

CTES: dict[str, tuple[tuple[str, ...], str]] = {}


def cte(name: str, sql: str, *needs: str) -> None:
    CTES[name] = (needs, sql)


cte("accounts", """
SELECT o.o_orderkey, CAST(o.o_custkey AS VARCHAR) AS unique_customer_identifier,
  CAST(o.o_orderdate AS DATE) AS o_orderdate, o.o_orderstatus, o.o_orderpriority, c.c_mktsegment, o.o_totalprice,
  CAST(date_trunc('month', o.o_orderdate) AS DATE) AS datevalue,
  CASE o.o_orderpriority WHEN '1-URGENT' THEN '06 OOC' WHEN '2-HIGH' THEN '05 Newly OOC'
       WHEN '3-MEDIUM' THEN '03 Soon to be OOC' WHEN '5-LOW' THEN ' 02 In Contract' END AS contract_status,
  CASE WHEN o.o_orderkey % 53 <> 0 THEN CAST(o.o_orderkey % 400 - 200 AS DOUBLE) END AS ooc_days,
  CASE WHEN o.o_orderkey % 59 <> 0 THEN CAST(o.o_orderkey % 3 AS DOUBLE) END AS contract_dd_cancels,
  CASE WHEN o.o_orderkey % 7 = 0 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS dd_cancel_60_day,
  CASE c.c_mktsegment WHEN 'AUTOMOBILE' THEN 'FTTC' WHEN 'BUILDING' THEN 'FTTP' WHEN 'FURNITURE' THEN 'GFAST'
       WHEN 'HOUSEHOLD' THEN 'MPF' END AS technology,
  s.speed,
  CASE WHEN o.o_orderkey % 67 <> 0 THEN s.speed * (0.6::DOUBLE + CAST(o.o_orderkey % 60 AS DOUBLE) / 100.0::DOUBLE) END AS line_speed,
  n.n_name AS sales_channel, c.c_mktsegment || ' ' || o.o_orderpriority AS crm_package_name,
  CAST(date_diff('day', f.first_order, CAST(o.o_orderdate AS DATE)) AS DOUBLE) AS tenure_days
FROM orders o JOIN customer c ON c.c_custkey = o.o_custkey JOIN nation n ON n.n_nationkey = c.c_nationkey
JOIN (SELECT o_custkey, min(CAST(o_orderdate AS DATE)) AS first_order FROM orders GROUP BY 1) f ON f.o_custkey = o.o_custkey
JOIN (SELECT o_orderkey, CASE WHEN o_orderkey % 101 = 0 THEN 0.0::DOUBLE WHEN o_orderkey % 4 = 0 THEN 40.0::DOUBLE
      WHEN o_orderkey % 4 = 1 THEN 55.0::DOUBLE WHEN o_orderkey % 4 = 2 THEN 80.0::DOUBLE ELSE 160.0::DOUBLE END AS speed
      FROM orders) s ON s.o_orderkey = o.o_orderkey""")
cte("panel", """
SELECT unique_customer_identifier, datevalue, contract_status, ooc_days, contract_dd_cancels, dd_cancel_60_day, technology,
  speed, line_speed, sales_channel, crm_package_name, tenure_days FROM accounts""", "accounts")
cte("calls", """
SELECT CAST(o.o_custkey AS VARCHAR) AS unique_customer_identifier, CAST(l.l_shipdate AS DATE) AS event_date,
  CASE l.l_returnflag WHEN 'R' THEN 'Loyalty' WHEN 'A' THEN 'Tech' WHEN 'N' THEN 'Billing' END AS call_type,
  l.l_quantity * 12 AS talk_time_seconds, CASE WHEN l.l_linenumber <> 7 THEN l.l_tax * 1000 END AS hold_time_seconds
FROM lineitem l JOIN orders o ON o.o_orderkey = l.l_orderkey""")
cte("usage", """
SELECT CAST(user_id AS VARCHAR) AS unique_customer_identifier,
  CAST(DATE '1998-06-15' - CAST(3 * date_diff('day', CAST(ts AS DATE), DATE '2024-01-31') AS INTEGER) AS DATE) AS calendar_date,
  CASE WHEN event_id % 97 = 0 THEN 'n/a' WHEN event_id % 89 = 0 THEN NULL WHEN event_id % 41 = 0 THEN '0'
       ELSE CAST(value AS VARCHAR) END AS usage_download_mbs,
  json_extract_string(props, '$.k') AS usage_upload_mbs
FROM events""")
cte("usage_num", f"""
SELECT unique_customer_identifier, calendar_date, {num('usage_download_mbs')} AS dl, {num('usage_upload_mbs')} AS ul,
  usage_download_mbs, usage_upload_mbs FROM usage""", "usage")
cte("cease_keyed", """
SELECT o_orderkey, CAST(o_custkey AS VARCHAR) AS unique_customer_identifier, CAST(o_orderdate AS DATE) AS cease_placed_date,
  CASE WHEN o_orderkey % 3 <> 0 THEN CAST(CAST(o_orderdate AS DATE) + CAST(o_orderkey % 40 - 2 AS INTEGER) AS VARCHAR) END AS cease_completed_date,
  CASE WHEN o_orderkey % 211 = 0 THEN 'INVALID' ELSE (['CompetitorDeals','VagueReason','HomeMove','Bereavement','Other','BadDebtDisconnect',
   'CustomerServices','Installation&Provisioning','Mis-sold','TV','TechnicalIssue'])[CAST(o_orderkey % 11 + 1 AS INTEGER)] END AS reason_description_insight
FROM orders WHERE o_orderstatus = 'F'""")
cte("cease", "SELECT * EXCLUDE (o_orderkey) FROM cease_keyed", "cease_keyed")
cte("first_cease", "SELECT unique_customer_identifier, min(cease_placed_date) AS first_cease FROM cease GROUP BY 1", "cease")
cte("scored", f"""
SELECT o_orderkey AS id, CAST(o_orderstatus = 'F' AS INTEGER) AS y,
  ((7 * ({h32('o_orderkey')} % 10000) + CASE WHEN o_orderstatus = 'F' THEN 30000 ELSE 0 END + 5) // 10) / 10000.0::DOUBLE AS p
FROM orders""")
cte("scored_accounts", "SELECT a.*, s.id, s.y, s.p FROM accounts a JOIN scored s ON s.id = a.o_orderkey", "accounts", "scored")
cte("lifetimes", """
SELECT o.o_orderkey AS id, CAST(greatest(1, abs(date_diff('day', CAST(o.o_orderdate AS DATE), s.ship))) AS INTEGER) AS duration,
  CAST(o.o_orderstatus = 'F' AS INTEGER) AS event, CAST(o.o_orderpriority IN ('1-URGENT', '2-HIGH') AS INTEGER) AS urgent,
  c.c_mktsegment AS segment, o.o_totalprice AS price, CAST(o.o_orderkey % 7 = 0 AS INTEGER) AS dd_flag
FROM orders o JOIN (SELECT l_orderkey, min(CAST(l_shipdate AS DATE)) AS ship FROM lineitem GROUP BY 1) s ON s.l_orderkey = o.o_orderkey
JOIN customer c ON c.c_custkey = o.o_custkey""")
cte("drift_long", """
SELECT side, feature, value FROM (
 SELECT CASE WHEN CAST(l_shipdate AS DATE) < DATE '1998-06-01' THEN 'ref' ELSE 'cur' END AS side, l_quantity, l_extendedprice,
  CASE WHEN CAST(l_shipdate AS DATE) < DATE '1998-06-01' THEN l_discount ELSE l_discount * 1.5::DOUBLE END AS l_discount, l_tax
 FROM lineitem) UNPIVOT (value FOR feature IN (l_quantity, l_extendedprice, l_discount, l_tax))""")


def with_ctes(*names: str) -> str:
    """``WITH`` clause holding the named mappings and whatever they build on."""
    order: list[str] = []

    def visit(name: str) -> None:
        for need in CTES[name][0]:
            visit(need)
        if name not in order:
            order.append(name)

    for name in names:
        visit(name)
    return "WITH " + ",\n".join(f"{n} AS ({CTES[n][1]})" for n in order) + "\n"


def sql(names: str, body: str) -> str:
    """Full statement: mapping CTEs (space-separated names) followed by ``body``.

    A body that starts with a comma goes on with CTEs of its own.
    """
    head = with_ctes(*names.split())
    body = body.strip()
    return head + body

"""DuckDB oracle SQL for every registered query.

The fixture CTEs below are the SQL twins of :mod:`ebbflow.plans.fixtures`.
Each oracle is written the plain way (ordinary windows, self joins) so it
checks the distributed formulation used on the Spark side.
"""

from __future__ import annotations

# ------------------------------------------------------------------ fixture CTEs
K = "CAST(json_extract_string(props, '$.k') AS INTEGER)"
OPEN_END = "TIMESTAMP '2262-01-01 00:00:00'"   # same sentinel as ebbflow.functions.expr.OPEN_END

FIX = {
    "trans": f"""trans AS (
        SELECT event_id AS trans_id, ts AS trans_date, lpad(CAST(user_id AS VARCHAR), 16, '0') AS card_num,
               event_type AS oper_type, value AS amt,
               CASE WHEN event_type IN ('purchase', 'signup') THEN 'SUCCESS' ELSE 'REJECT' END AS oper_result,
               'T' || lpad(CAST({K} AS VARCHAR), 4, '0') AS terminal
        FROM events)""",
    "terminals": f"""terminals AS (
        SELECT DISTINCT 'T' || lpad(CAST(k AS VARCHAR), 4, '0') AS terminal_id,
               'City' || CAST(k % 10 AS VARCHAR) AS terminal_city
        FROM (SELECT {K} AS k FROM events))""",
    "clients": """clients AS (
        SELECT c_custkey AS client_id, c_name AS last_name, c_mktsegment AS first_name,
               CASE WHEN c_custkey % 9 = 0 THEN NULL ELSE 'P' || CAST(c_nationkey AS VARCHAR) END AS patronymic,
               lpad(CAST(c_custkey AS VARCHAR), 10, '0') AS passport_num,
               CASE WHEN c_custkey % 11 = 0 THEN NULL
                    ELSE CAST(DATE '2024-01-01' + CAST((7 * c_custkey) % 60 AS INTEGER) AS DATE) END AS passport_valid_to,
               '+7' || lpad(CAST(c_custkey AS VARCHAR), 10, '0') AS phone
        FROM customer)""",
    "accounts": """accounts AS (
        SELECT '40817' || lpad(CAST(c_custkey AS VARCHAR), 15, '0') AS account_num, c_custkey AS client,
               CAST(DATE '2024-01-01' + CAST((5 * c_custkey) % 50 AS INTEGER) AS DATE) AS valid_to
        FROM customer)""",
    "cards": """cards AS (
        SELECT lpad(CAST(c_custkey AS VARCHAR), 16, '0') || ' ' AS card_num,
               '40817' || lpad(CAST(c_custkey AS VARCHAR), 15, '0') AS account_num
        FROM customer)""",
    "blacklist": """blacklist AS (
        SELECT CAST(DATE '2024-01-10' + CAST(c_custkey % 15 AS INTEGER) AS DATE) AS entry_dt,
               lpad(CAST(c_custkey AS VARCHAR), 10, '0') AS passport_num
        FROM customer WHERE c_custkey % 13 = 5)""",
    "star": """star AS (
        SELECT trim(cr.card_num) AS card_num, cl.client_id,
               concat(coalesce(cl.last_name, ''), ' ', coalesce(cl.first_name, ''), ' ', coalesce(cl.patronymic, '')) AS fio,
               cl.passport_num, cl.passport_valid_to, cl.phone, acc.valid_to AS account_valid_to
        FROM accounts acc JOIN clients cl ON acc.client = cl.client_id
        JOIN cards cr ON acc.account_num = cr.account_num)""",
    "ct": """ct AS (
        SELECT t.*, s.client_id, s.fio, s.passport_num, s.phone, tm.terminal_city
        FROM trans t JOIN star s USING (card_num) LEFT JOIN terminals tm ON t.terminal = tm.terminal_id)""",
}

DEPS = {
    "star": ["accounts", "clients", "cards"],
    "ct": ["trans", "star", "terminals"],
}


def with_(*names: str) -> str:
    """WITH clause holding the named fixtures and their dependencies, in order."""
    order: list[str] = []

    def add(n: str) -> None:
        for d in DEPS.get(n, []):
            add(d)
        if n not in order:
            order.append(n)

    for n in names:
        add(n)
    return "WITH " + ",\n".join(FIX[n] for n in order) + "\n"


def with_chains(*names: str) -> str:
    """The same over the operations with chains of rejected tries."""
    feed = FIX["trans"].replace("trans AS (", "feed AS (", 1)
    return with_(*names).replace(FIX["trans"], feed + """,
trans AS (
        SELECT trans_id, trans_date, card_num, oper_type, amt, oper_result, terminal FROM feed
        UNION ALL
        SELECT -(trans_id * 4 + i), trans_date - i * INTERVAL 5 MINUTE, card_num, oper_type, amt + i * 10, 'REJECT', terminal
        FROM feed CROSS JOIN (VALUES (1), (2), (3)) AS tries(i) WHERE trans_id % 40 = 0 AND oper_result = 'SUCCESS')""")


def _fraud_select(event_type: int, passport: str = "passport_num") -> str:
    return (f"SELECT DISTINCT trans_date AS event_dt, {passport} AS passport, fio, phone, "
            f"{event_type} AS event_type, CAST(trans_date AS DATE) AS report_dt")


REPORT_DT = "TIMESTAMP '2024-01-01 00:00:00'"

SQL_FRAUD_PASSPORT = with_("trans", "star", "blacklist") + f"""
{_fraud_select(1, "coalesce(s.passport_num, bl.passport_num)")}
FROM trans t JOIN star s USING (card_num) LEFT JOIN blacklist bl ON s.passport_num = bl.passport_num
WHERE (CAST(t.trans_date AS DATE) > s.passport_valid_to OR (bl.passport_num IS NOT NULL AND t.trans_date > bl.entry_dt))
  AND t.trans_date >= {REPORT_DT}"""

SQL_FRAUD_CONTRACT = with_("trans", "star") + f"""
{_fraud_select(2)}
FROM trans t JOIN star s USING (card_num)
WHERE s.account_valid_to < CAST(t.trans_date AS DATE) AND t.trans_date >= {REPORT_DT}"""

SQL_FRAUD_TWO_CITIES = with_("ct") + f""",
l AS (SELECT *, lag(terminal_city) OVER w AS pc, lag(trans_date) OVER w AS pd
      FROM ct WHERE terminal_city IS NOT NULL WINDOW w AS (PARTITION BY client_id ORDER BY trans_date, trans_id))
{_fraud_select(3)}
FROM l
WHERE terminal_city <> coalesce(pc, terminal_city) AND trans_date <= coalesce(pd, trans_date) + INTERVAL 1 HOUR
  AND trans_date >= {REPORT_DT}"""


def _sql_guessing(window: str) -> str:
    return with_chains("ct") + f""",
l AS (SELECT *,
        lag(trans_date, 3) OVER w AS d3,
        lag(amt, 1) OVER w AS a1, lag(amt, 2) OVER w AS a2, lag(amt, 3) OVER w AS a3,
        lag(oper_result, 1) OVER w AS r1, lag(oper_result, 2) OVER w AS r2, lag(oper_result, 3) OVER w AS r3
      FROM ct WINDOW w AS (PARTITION BY client_id ORDER BY trans_date, trans_id))
{_fraud_select(4)}
FROM l
WHERE oper_result = 'SUCCESS' AND r1 = 'REJECT' AND r2 = 'REJECT' AND r3 = 'REJECT'
  AND a3 > a2 AND a2 > a1 AND a1 > amt AND trans_date <= d3 + INTERVAL {window}
  AND trans_date >= {REPORT_DT}"""


SQL_FRAUD_GUESSING = _sql_guessing("20 MINUTE")


SQL_FRAUD_MART = with_chains("ct", "blacklist") + f""",
l3 AS (SELECT *, lag(terminal_city) OVER w AS pc, lag(trans_date) OVER w AS pd
       FROM ct WHERE terminal_city IS NOT NULL WINDOW w AS (PARTITION BY client_id ORDER BY trans_date, trans_id)),
l4 AS (SELECT *, lag(trans_date, 3) OVER w AS d3,
        lag(amt, 1) OVER w AS a1, lag(amt, 2) OVER w AS a2, lag(amt, 3) OVER w AS a3,
        lag(oper_result, 1) OVER w AS r1, lag(oper_result, 2) OVER w AS r2, lag(oper_result, 3) OVER w AS r3
       FROM ct WINDOW w AS (PARTITION BY client_id ORDER BY trans_date, trans_id))
{_fraud_select(1, "coalesce(s.passport_num, bl.passport_num)")}
FROM trans t JOIN star s USING (card_num) LEFT JOIN blacklist bl ON s.passport_num = bl.passport_num
WHERE (CAST(t.trans_date AS DATE) > s.passport_valid_to OR (bl.passport_num IS NOT NULL AND t.trans_date > bl.entry_dt))
  AND t.trans_date >= {REPORT_DT}
UNION ALL
{_fraud_select(2)}
FROM trans t JOIN star s USING (card_num)
WHERE s.account_valid_to < CAST(t.trans_date AS DATE) AND t.trans_date >= {REPORT_DT}
UNION ALL
{_fraud_select(3)}
FROM l3
WHERE terminal_city <> coalesce(pc, terminal_city) AND trans_date <= coalesce(pd, trans_date) + INTERVAL 1 HOUR
  AND trans_date >= {REPORT_DT}
UNION ALL
{_fraud_select(4)}
FROM l4
WHERE oper_result = 'SUCCESS' AND r1 = 'REJECT' AND r2 = 'REJECT' AND r3 = 'REJECT'
  AND a3 > a2 AND a2 > a1 AND a1 > amt AND trans_date <= d3 + INTERVAL 20 MINUTE
  AND trans_date >= {REPORT_DT}"""

SQL_CLIENT_CARD_STAR = with_("star") + "SELECT * FROM star"

SQL_FULL_NAME = with_("clients") + """
SELECT client_id, concat(coalesce(last_name, ''), ' ', coalesce(first_name, ''), ' ', coalesce(patronymic, '')) AS fio
FROM clients"""

SQL_LEFT_LOOKUP = with_("trans", "star", "blacklist") + """
SELECT t.trans_id, s.passport_num, bl.entry_dt
FROM trans t JOIN star s USING (card_num) LEFT JOIN blacklist bl ON s.passport_num = bl.passport_num"""

SQL_LEAD_DEFAULT = with_("ct") + """
SELECT trans_id, client_id, terminal_city,
       coalesce(lead(terminal_city) OVER w, terminal_city) AS next_city,
       trans_date,
       coalesce(lead(trans_date) OVER w, trans_date) AS next_dt
FROM ct WINDOW w AS (PARTITION BY client_id ORDER BY trans_date, trans_id)"""

SQL_LEAD_CHAIN = with_("ct") + "SELECT trans_id, client_id, trans_date, amt, oper_result, " + ", ".join(
    f"coalesce(lead({c}, {i}) OVER w, {c}) AS lead_{c}_{i}"
    for c in ("trans_date", "amt", "oper_result") for i in (1, 2, 3)
) + " FROM ct WINDOW w AS (PARTITION BY client_id ORDER BY trans_date, trans_id)"

SQL_FACT_APPEND = with_("trans") + "SELECT trans_id, trans_date, card_num, oper_type, amt, oper_result, terminal FROM trans"

ORACLE: dict[str, str] = {
    "fraud_passport": SQL_FRAUD_PASSPORT,
    "fraud_contract": SQL_FRAUD_CONTRACT,
    "fraud_two_cities": SQL_FRAUD_TWO_CITIES,
    "fraud_amount_guessing": SQL_FRAUD_GUESSING,
    "fraud_mart": SQL_FRAUD_MART,
    "client_card_star": SQL_CLIENT_CARD_STAR,
    "full_name": SQL_FULL_NAME,
    "left_lookup": SQL_LEFT_LOOKUP,
    "lead_default": SQL_LEAD_DEFAULT,
    "lead_chain": SQL_LEAD_CHAIN,
}


# ------------------------------------------------------------------ SCD2
FIX.update({
    "dim": f"""dim AS (
        SELECT c_custkey, c_acctbal, c_mktsegment, TIMESTAMP '2024-01-01 00:00:00' AS effective_from,
               {OPEN_END} AS effective_to, false AS is_deleted
        FROM customer)""",
    "stg": """stg AS (
        SELECT c_custkey,
               CASE WHEN c_custkey % 20 = 3 THEN NULL WHEN c_custkey % 10 = 0 THEN c_acctbal + 100 ELSE c_acctbal END AS c_acctbal,
               c_mktsegment, TIMESTAMP '2024-01-02 00:00:00' AS change_ts
        FROM customer WHERE c_custkey % 5 IN (0, 1, 3)
        UNION ALL
        SELECT c_custkey + 1000000, c_acctbal, c_mktsegment, TIMESTAMP '2024-01-02 00:00:00'
        FROM customer WHERE c_custkey % 50 = 0)""",
    "live": """live AS (
        SELECT c_custkey FROM customer WHERE c_custkey % 25 <> 7
        UNION ALL SELECT c_custkey + 1000000 FROM customer WHERE c_custkey % 50 = 0)""",
    "ch": f"""ch AS (
        SELECT s.c_custkey, s.c_acctbal, s.c_mktsegment, d.c_acctbal AS prev_c_acctbal,
               d.c_mktsegment AS prev_c_mktsegment, s.change_ts
        FROM stg s JOIN dim d ON s.c_custkey = d.c_custkey AND d.effective_to = {OPEN_END} AND NOT d.is_deleted
        WHERE (s.c_acctbal IS DISTINCT FROM d.c_acctbal OR s.c_mktsegment IS DISTINCT FROM d.c_mktsegment)
          AND s.change_ts > d.effective_from)""",
    "nw": f"""nw AS (
        SELECT * FROM stg WHERE c_custkey NOT IN (
            SELECT c_custkey FROM dim WHERE effective_to = {OPEN_END} AND NOT is_deleted))""",
    "versions": f"""versions AS (
        SELECT d.c_custkey, d.c_acctbal, d.c_mktsegment, d.effective_from,
               CASE WHEN ch.c_custkey IS NOT NULL THEN ch.change_ts - INTERVAL 15 SECOND ELSE d.effective_to END AS effective_to,
               d.is_deleted, d.c_custkey + 1 AS sk
        FROM dim d LEFT JOIN ch ON d.c_custkey = ch.c_custkey
        UNION ALL
        SELECT c_custkey, c_acctbal, c_mktsegment, change_ts, {OPEN_END}, false, c_custkey + 1 FROM ch
        UNION ALL
        SELECT c_custkey, c_acctbal, c_mktsegment, change_ts, {OPEN_END}, false,
               (SELECT max(c_custkey) + 1 FROM customer) + row_number() OVER (ORDER BY c_custkey) FROM nw)""",
    "merged": f"""merged AS (
        SELECT c_custkey, c_acctbal, c_mktsegment, effective_from,
               CASE WHEN effective_to = {OPEN_END} AND NOT is_deleted AND c_custkey NOT IN (SELECT c_custkey FROM live)
                    THEN TIMESTAMP '2024-01-03 00:00:00' - INTERVAL 15 SECOND ELSE effective_to END AS effective_to,
               is_deleted, sk
        FROM versions
        UNION ALL
        SELECT c_custkey, c_acctbal, c_mktsegment, TIMESTAMP '2024-01-03 00:00:00', {OPEN_END}, true, sk
        FROM versions
        WHERE effective_to = {OPEN_END} AND NOT is_deleted AND c_custkey NOT IN (SELECT c_custkey FROM live))""",
})
DEPS.update({
    "ch": ["dim", "stg"],
    "nw": ["dim", "stg"],
    "versions": ["dim", "ch", "nw"],
    "merged": ["versions", "live"],
})

ORACLE.update({
    "key_snapshot": with_("live") + "SELECT DISTINCT c_custkey FROM live",
    "semi_join_keys": with_("dim", "stg") + "SELECT * FROM dim WHERE c_custkey IN (SELECT c_custkey FROM stg)",
    "scd2_new_keys": with_("nw") + f"""
        SELECT c_custkey, c_acctbal, c_mktsegment, change_ts AS effective_from, {OPEN_END} AS effective_to,
               false AS is_deleted FROM nw""",
    "scd2_changes": with_("ch") + "SELECT * FROM ch",
    "scd2_close": with_("ch") + f"""
        SELECT d.c_custkey, d.c_acctbal, d.c_mktsegment, d.effective_from,
               ch.change_ts - INTERVAL 15 SECOND AS effective_to, d.is_deleted
        FROM dim d JOIN ch ON d.c_custkey = ch.c_custkey""",
    "scd2_reopen": with_("ch") + f"""
        SELECT c_custkey, c_acctbal, c_mktsegment, change_ts AS effective_from, {OPEN_END} AS effective_to,
               false AS is_deleted FROM ch""",
    "scd2_tombstone": with_("dim", "live") + f"""
        SELECT c_custkey, c_acctbal, c_mktsegment, effective_from,
               TIMESTAMP '2024-01-03 00:00:00' - INTERVAL 15 SECOND AS effective_to, is_deleted
        FROM dim WHERE c_custkey NOT IN (SELECT c_custkey FROM live)
        UNION ALL
        SELECT c_custkey, c_acctbal, c_mktsegment, TIMESTAMP '2024-01-03 00:00:00', {OPEN_END}, true
        FROM dim WHERE c_custkey NOT IN (SELECT c_custkey FROM live)""",
    "scd2_merge": with_("merged") + "SELECT c_custkey, c_acctbal, c_mktsegment, effective_from, effective_to, is_deleted FROM merged",
    "scd2_current": with_("merged") + f"""
        SELECT c_custkey, c_acctbal, c_mktsegment, effective_from, effective_to, is_deleted
        FROM merged WHERE effective_to = {OPEN_END}""",
    "surrogate_key": with_("merged") + "SELECT c_custkey, sk, effective_from, effective_to, is_deleted FROM merged",
    "scd2_from_events": f"""
        WITH d AS (SELECT o_custkey, o_orderdate, arg_max(o_orderpriority, o_orderkey) AS o_orderpriority
                   FROM orders GROUP BY o_custkey, o_orderdate),
        l AS (SELECT *, lag(o_orderpriority) OVER w AS pv, row_number() OVER w AS rn
              FROM d WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderdate)),
        k AS (SELECT * FROM l WHERE rn = 1 OR pv IS DISTINCT FROM o_orderpriority)
        SELECT o_custkey, o_orderpriority, o_orderdate AS effective_from,
               coalesce(lead(o_orderdate) OVER (PARTITION BY o_custkey ORDER BY o_orderdate) - INTERVAL 15 SECOND,
                        {OPEN_END}) AS effective_to
        FROM k""",
})


# ------------------------------------------------------------------ taxi
PHONE = "'+7' || lpad(CAST({k} AS VARCHAR), 10, '0')"
CARD16 = "lpad(CAST({k} AS VARCHAR), 16, '0')"


def _grouped_card(k: str) -> str:
    c = CARD16.format(k=k)
    return f"substr({c}, 1, 4) || ' ' || substr({c}, 5, 4) || ' ' || substr({c}, 9, 4) || ' ' || substr({c}, 13, 4)"


FIX.update({
    "movement": """movement AS (
        SELECT l_orderkey AS ride, l_suppkey AS car_plate_num,
               CASE WHEN l_linenumber <= 2 THEN 'READY' WHEN l_linenumber <= 4 THEN 'BEGIN' ELSE 'END' END AS event,
               l_shipdate AS dt
        FROM lineitem)""",
    "rides": f"""rides AS (
        SELECT o_orderkey AS ride_id, {PHONE.format(k='o_custkey')} AS client_phone,
               CAST(o_orderkey % 100 AS DECIMAL(5,2)) AS distance, CAST(o_totalprice AS DECIMAL(12,2)) AS price,
               o_orderdate AS dt
        FROM orders)""",
    "rpivot": """rpivot AS (
        SELECT r.ride_id, r.client_phone, r.distance, r.price, m.car_plate_num,
               m.ride_arrival_dt, m.ride_start_dt, m.ride_end_dt
        FROM rides r LEFT JOIN (
            SELECT ride, max(car_plate_num) AS car_plate_num,
                   max(CASE WHEN event = 'READY' THEN dt END) AS ride_arrival_dt,
                   max(CASE WHEN event = 'BEGIN' THEN dt END) AS ride_start_dt,
                   max(CASE WHEN event IN ('END', 'CANCEL') THEN dt END) AS ride_end_dt
            FROM movement GROUP BY ride) m ON r.ride_id = m.ride)""",
    "waybills": """waybills AS (
        SELECT lpad(CAST(o_orderkey AS VARCHAR), 6, '0') AS waybill_num, o_custkey AS driver_pers_num,
               'DL' || lpad(CAST(o_custkey AS VARCHAR), 10, '0') AS driver_license,
               o_orderkey % (SELECT count(*) FROM supplier) AS car_plate_num,
               o_orderdate AS work_start_dt, o_orderdate + INTERVAL 10 DAY AS work_end_dt, o_orderdate AS issue_dt
        FROM orders)""",
    "arrivals": """arrivals AS (
        SELECT l_orderkey AS ride_id, l_linenumber AS ride_line, l_suppkey AS car_plate_num, l_shipdate AS ride_arrival_dt
        FROM lineitem)""",
    "drivers": f"""drivers AS (
        SELECT c_custkey AS personnel_num, 'DL' || lpad(CAST(c_custkey AS VARCHAR), 10, '0') AS driver_license_num,
               c_name AS last_name, c_mktsegment AS first_name,
               CASE WHEN c_custkey % 9 = 0 THEN NULL ELSE 'P' || CAST(c_nationkey AS VARCHAR) END AS middle_name,
               {_grouped_card('c_custkey')} AS card_num
        FROM customer)""",
    "trip_events": """trip_events AS (
        SELECT user_id AS personnel_num, event_id AS ride, ts, value * 10 AS distance_val FROM events)""",
    "trips": """trips AS (
        SELECT * FROM (
            SELECT personnel_num, ride, distance_val, ts AS ride_start_dt,
                   lead(ts) OVER (PARTITION BY personnel_num ORDER BY ts, ride) AS ride_end_dt
            FROM trip_events)
        WHERE ride_end_dt IS NOT NULL)""",
    "violations": """violations AS (
        SELECT personnel_num, ride, speed,
               row_number() OVER (PARTITION BY personnel_num ORDER BY ride_end_dt, ride) AS violations_cnt,
               CAST(ride_end_dt AS DATE) AS report_dt
        FROM (SELECT *, round(distance_val / date_sub('second', ride_start_dt, ride_end_dt) * 3600) AS speed
              FROM trips WHERE date_sub('second', ride_start_dt, ride_end_dt) > 0)
        WHERE speed > 85)""",
    "shifts": f"""shifts AS (
        SELECT user_id AS driver_pers_num, event_id AS waybill_id, ts AS work_start_dt,
               ts + to_hours(CAST({K} % 8 + 1 AS BIGINT)) AS work_end_dt
        FROM events)""",
    "fact_rides": f"""fact_rides AS (
        SELECT o_orderkey AS ride_id, o_custkey AS driver_pers_num, {PHONE.format(k='o_custkey')} AS client_phone_num,
               CAST(o_totalprice AS DECIMAL(12,2)) AS price_amt, CAST(o_orderkey % 100 AS DECIMAL(5,2)) AS distance_val,
               o_orderdate AS ride_arrival_dt,
               CASE WHEN o_orderstatus = 'P' THEN NULL ELSE o_orderdate END AS ride_start_dt,
               o_orderdate AS ride_end_dt
        FROM orders)""",
    "payments": f"""payments AS (
        SELECT {CARD16.format(k='l_orderkey % (SELECT count(*) FROM customer)')} AS card_num,
               CAST(l_extendedprice AS DECIMAL(12,2)) AS transaction_amt, l_shipdate AS transaction_dt, l_orderkey
        FROM lineitem)""",
    "taxi_clients": f"""taxi_clients AS (
        SELECT {PHONE.format(k='c_custkey')} AS phone_num, {_grouped_card('c_custkey')} AS card_num FROM customer)""",
})
DEPS.update({
    "rpivot": ["movement", "rides"],
    "trips": ["trip_events"],
    "violations": ["trips"],
})


#: Report runs of the metrics history.
HIST_RUNS = ["1997-01-01 00:00:00", "1999-01-01 00:00:00", "2010-01-01 00:00:00"]


def _metrics_sql(cut: str | None) -> str:
    rf = f"WHERE ride_arrival_dt < TIMESTAMP '{cut}'" if cut else ""
    pf = f"WHERE transaction_dt < TIMESTAMP '{cut}'" if cut else ""
    return f"""(
        SELECT c.phone_num,
               coalesce(r.rides_cnt, 0) AS rides_cnt, coalesce(r.cancelled_cnt, 0) AS cancelled_cnt,
               CAST(coalesce(r.spent_amt, 0) AS DECIMAL(22,2)) AS spent_amt,
               CAST(coalesce(r.spent_amt, 0) - coalesce(p.paid, 0) AS DECIMAL(22,2)) AS debt_amt
        FROM (SELECT DISTINCT phone_num FROM taxi_clients) c
        LEFT JOIN (SELECT client_phone_num, count(ride_start_dt) AS rides_cnt,
                          count(CASE WHEN ride_start_dt IS NULL THEN ride_id END) AS cancelled_cnt,
                          sum(CASE WHEN ride_start_dt IS NOT NULL THEN price_amt END) AS spent_amt
                   FROM fact_rides {rf} GROUP BY client_phone_num) r ON c.phone_num = r.client_phone_num
        LEFT JOIN (SELECT cc.phone_num, sum(pp.amt) AS paid
                   FROM (SELECT DISTINCT phone_num, replace(card_num, ' ', '') AS card_num FROM taxi_clients) cc
                   LEFT JOIN (SELECT card_num, sum(transaction_amt) AS amt FROM payments {pf} GROUP BY card_num) pp
                          ON cc.card_num = pp.card_num
                   GROUP BY cc.phone_num) p ON c.phone_num = p.phone_num)"""


_ROLL = """epoch_us(least(t.work_end_dt, s.work_start_dt + INTERVAL 24 HOUR)) - epoch_us(t.work_start_dt)"""

ORACLE.update({
    "ride_pivot": with_("rpivot") + "SELECT * FROM rpivot",
    "ride_completed": with_("rpivot") + "SELECT * FROM rpivot WHERE ride_end_dt IS NOT NULL",
    "driver_assignment": with_("waybills", "arrivals") + """,
        c AS (SELECT a.*, w.waybill_num, w.driver_pers_num,
                     row_number() OVER (PARTITION BY a.ride_id, a.ride_line, a.car_plate_num, a.ride_arrival_dt
                                        ORDER BY w.work_start_dt, w.waybill_num) AS rk
              FROM arrivals a LEFT JOIN waybills w ON a.car_plate_num = w.car_plate_num
                   AND a.ride_arrival_dt BETWEEN w.work_start_dt AND w.work_end_dt)
        SELECT ride_id, ride_line, car_plate_num, ride_arrival_dt, waybill_num, driver_pers_num FROM c WHERE rk = 1""",
    "top1_per_key": with_("waybills", "arrivals") + """,
        c AS (SELECT a.*, w.waybill_num, w.driver_pers_num,
                     row_number() OVER (PARTITION BY a.ride_id, a.ride_line, a.car_plate_num, a.ride_arrival_dt
                                        ORDER BY w.work_start_dt, w.waybill_num) AS rk
              FROM arrivals a JOIN waybills w ON a.car_plate_num = w.car_plate_num
                   AND a.ride_arrival_dt BETWEEN w.work_start_dt AND w.work_end_dt)
        SELECT ride_id, ride_line, car_plate_num, ride_arrival_dt, waybill_num, driver_pers_num FROM c WHERE rk = 1""",
    "waybill_merge": with_("waybills", "drivers") + """
        SELECT w.waybill_num, d.personnel_num AS driver_pers_num, w.car_plate_num, w.work_start_dt, w.work_end_dt,
               w.issue_dt
        FROM waybills w LEFT JOIN drivers d ON w.driver_license = d.driver_license_num""",
    "driver_payout": with_("fact_rides", "drivers") + """
        SELECT d.personnel_num, d.last_name, d.first_name, d.middle_name, d.card_num,
               CAST(sum(r.price_amt) * 0.8 - sum(r.distance_val) * 8.3082 AS DECIMAL(24,6)) AS amount,
               CAST(r.ride_arrival_dt AS DATE) AS report_dt
        FROM fact_rides r JOIN drivers d ON d.personnel_num = r.driver_pers_num
        WHERE r.ride_start_dt IS NOT NULL
        GROUP BY d.personnel_num, d.last_name, d.first_name, d.middle_name, d.card_num, CAST(r.ride_arrival_dt AS DATE)""",
    "driver_violations": with_("violations") + "SELECT * FROM violations",
    "driver_violations_daily": with_("violations") + "SELECT * FROM violations WHERE report_dt = DATE '2024-01-05'",
    "partition_count": with_("violations") + """
        SELECT personnel_num, ride, count(*) OVER (PARTITION BY personnel_num) AS total_violations FROM violations""",
    "first_value_anchor": with_("shifts") + """
        SELECT waybill_id, driver_pers_num, work_start_dt,
               first_value(work_start_dt) OVER (PARTITION BY driver_pers_num, CAST(work_start_dt AS DATE)
                                                ORDER BY work_start_dt) AS anchor_dt
        FROM shifts""",
    "driver_overtime": with_("shifts") + """,
        s AS (SELECT *, first_value(work_start_dt) OVER (PARTITION BY driver_pers_num ORDER BY work_start_dt) AS anchor_dt
              FROM shifts WHERE CAST(work_start_dt AS DATE) = DATE '2024-01-05')
        SELECT driver_pers_num AS personnel_num, anchor_dt AS start_work_dt,
               CAST(sum(epoch_us(least(work_end_dt, anchor_dt + INTERVAL 24 HOUR)) - epoch_us(work_start_dt)) AS DOUBLE) / 1e6
                   AS working_time_sec,
               CAST(anchor_dt AS DATE) AS report_dt
        FROM s GROUP BY driver_pers_num, anchor_dt
        HAVING sum(epoch_us(least(work_end_dt, anchor_dt + INTERVAL 24 HOUR)) - epoch_us(work_start_dt)) > 28800000000""",
    "driver_overtime_rolling": with_("shifts") + f"""
        SELECT s.driver_pers_num AS personnel_num, s.waybill_id, s.work_start_dt AS start_work_dt,
               CAST(sum({_ROLL}) AS DOUBLE) / 1e6 AS working_time_sec, CAST(s.work_start_dt AS DATE) AS report_dt
        FROM shifts s JOIN shifts t ON s.driver_pers_num = t.driver_pers_num
             AND t.work_start_dt BETWEEN s.work_start_dt AND s.work_start_dt + INTERVAL 24 HOUR
        GROUP BY s.driver_pers_num, s.waybill_id, s.work_start_dt
        HAVING sum({_ROLL}) > 28800000000""",
    "driver_overtime_waybill": with_("shifts") + f""",
        c AS (SELECT s.driver_pers_num, s.waybill_id AS opened_by, s.work_start_dt AS start_work_dt, t.waybill_id, t.work_start_dt,
                     sum({_ROLL}) OVER (PARTITION BY s.driver_pers_num, s.waybill_id ORDER BY t.work_start_dt, t.waybill_id) AS so_far,
                     sum({_ROLL}) OVER (PARTITION BY s.driver_pers_num, s.waybill_id) AS worked
              FROM shifts s JOIN shifts t ON s.driver_pers_num = t.driver_pers_num
                   AND t.work_start_dt BETWEEN s.work_start_dt AND s.work_start_dt + INTERVAL 24 HOUR)
        SELECT driver_pers_num AS personnel_num, waybill_id, start_work_dt, CAST(worked AS DOUBLE) / 1e6 AS working_time_sec,
               CAST(work_start_dt AS DATE) AS report_dt
        FROM c WHERE so_far > 28800000000
        QUALIFY row_number() OVER (PARTITION BY driver_pers_num, opened_by ORDER BY work_start_dt, waybill_id) = 1""",
    "having_filter": with_("shifts") + """
        SELECT driver_pers_num AS personnel_num, CAST(work_start_dt AS DATE) AS work_day,
               CAST(sum(epoch_us(work_end_dt) - epoch_us(work_start_dt)) AS DOUBLE) / 1e6 AS working_time_sec
        FROM shifts GROUP BY 1, 2
        HAVING sum(epoch_us(work_end_dt) - epoch_us(work_start_dt)) > 28800000000""",
    "conditional_aggregates": with_("fact_rides") + """
        SELECT client_phone_num, count(ride_start_dt) AS rides_cnt,
               count(CASE WHEN ride_start_dt IS NULL THEN ride_id END) AS cancelled_cnt,
               CAST(sum(CASE WHEN ride_start_dt IS NOT NULL THEN price_amt END) AS DECIMAL(22,2)) AS spent_amt
        FROM fact_rides GROUP BY client_phone_num""",
    "sum_by_key": with_("payments") + """
        SELECT card_num, CAST(sum(transaction_amt) AS DECIMAL(22,2)) AS paid_total FROM payments GROUP BY card_num""",
    "client_metrics": with_("taxi_clients", "fact_rides", "payments") + f"SELECT * FROM {_metrics_sql(None)}",
    "client_metrics_hist": with_("taxi_clients", "fact_rides", "payments") + f""",
        m AS ({" UNION ALL ".join(f"SELECT TIMESTAMP '{t}' AS t, * FROM {_metrics_sql(t)}" for t in HIST_RUNS)}),
        prior AS (SELECT *, lag(t) OVER w AS t0, lag(rides_cnt) OVER w AS r0, lag(cancelled_cnt) OVER w AS c0,
                         lag(spent_amt) OVER w AS s0, lag(debt_amt) OVER w AS d0
                  FROM m WINDOW w AS (PARTITION BY phone_num ORDER BY t)),
        versions AS (SELECT * FROM prior WHERE t0 IS NULL OR rides_cnt IS DISTINCT FROM r0
                        OR cancelled_cnt IS DISTINCT FROM c0 OR spent_amt IS DISTINCT FROM s0 OR debt_amt IS DISTINCT FROM d0),
        ids AS (SELECT phone_num, row_number() OVER (ORDER BY phone_num) AS client_id FROM (SELECT DISTINCT phone_num FROM taxi_clients))
        SELECT client_id, phone_num, rides_cnt, cancelled_cnt, spent_amt, debt_amt, t AS start_dt,
               coalesce(lead(t) OVER (PARTITION BY phone_num ORDER BY t) - INTERVAL 15 SECOND, {OPEN_END}) AS end_dt,
               false AS deleted_flag
        FROM versions JOIN ids USING (phone_num)""",
})


# ------------------------------------------------------------------ sources, control state, upserts
FIX.update({
    "ocl": """ocl AS (
        SELECT o_orderkey, o_custkey, o_orderdate AS create_dt,
               CASE WHEN o_orderkey % 3 = 0 THEN NULL ELSE o_orderdate + INTERVAL 1 DAY END AS update_dt
        FROM orders)""",
    "docs": """docs AS (
        SELECT event_id AS id, user_id AS object_id, props AS object_value, ts AS update_ts FROM events)""",
})

_ORDERS_WM = "TIMESTAMP '1997-06-30 00:00:00'"
_DOC_WM = "TIMESTAMP '2024-01-15 00:00:00'"

ORACLE.update({
    "incr_scan_coalesced": with_("ocl") + f"""
        SELECT *, coalesce(update_dt, create_dt) AS change_dt FROM ocl
        WHERE coalesce(update_dt, create_dt) > {_ORDERS_WM}""",
    "incr_scan_column": with_("movement") + "SELECT * FROM movement WHERE dt > TIMESTAMP '1998-01-01 00:00:00'",
    "watermark_advance": with_("ocl", "movement", "docs") + f""",
        ctl AS (SELECT * FROM (VALUES ('orders', {_ORDERS_WM}),
                                      ('movement', TIMESTAMP '1998-01-01 00:00:00'),
                                      ('documents', {_DOC_WM}),
                                      ('documents_future', TIMESTAMP '2030-01-01 00:00:00')) t(source, watermark)),
        marks AS (
            SELECT 'orders' AS source, coalesce(update_dt, create_dt) AS ts FROM ocl
            WHERE coalesce(update_dt, create_dt) > {_ORDERS_WM}
            UNION ALL SELECT 'movement', dt FROM movement WHERE dt > TIMESTAMP '1998-01-01 00:00:00'
            UNION ALL SELECT 'documents', update_ts FROM docs WHERE update_ts > {_DOC_WM}
            UNION ALL SELECT 'documents_future', update_ts FROM docs WHERE update_ts > TIMESTAMP '2030-01-01 00:00:00')
        SELECT c.source, greatest(coalesce(m.mx, c.watermark), c.watermark) AS watermark
        FROM ctl c LEFT JOIN (SELECT source, max(ts) AS mx FROM marks GROUP BY source) m ON c.source = m.source""",
    "settings_checkpoint": with_("docs") + f"""
        SELECT 'users_stg' AS workflow_key,
               CAST(json_object('last_loaded_ts', strftime(max(update_ts), '%Y-%m-%d %H:%M:%S.%f')) AS VARCHAR)
                   AS workflow_settings
        FROM docs WHERE update_ts > {_DOC_WM}
        UNION ALL
        SELECT 'users_mart', CAST(json_object('last_loaded_id', max(id)) AS VARCHAR) FROM docs WHERE id > -1""",
    "scd1_upsert": with_("docs") + """
        SELECT id, object_id, object_value, update_ts FROM (
            SELECT *, row_number() OVER (PARTITION BY object_id ORDER BY update_ts DESC, id DESC) AS rn FROM docs)
        WHERE rn = 1""",
    "doc_batch_pull": with_("docs") + f"""
        SELECT * FROM docs WHERE update_ts > {_DOC_WM}""",
    "json_extract_updates": with_("docs") + """
        SELECT id, update_ts + INTERVAL 100 DAY AS update_ts, 'u' || CAST(id AS VARCHAR) AS user_name
        FROM docs WHERE id % 10 = 0 AND update_ts + INTERVAL 100 DAY > (SELECT max(update_ts) FROM docs)""",
    "json_extract_batch": with_("docs") + """
        SELECT id, object_id, user_name FROM (
            SELECT id, object_id, json_extract_string(object_value, '$.k') AS user_name,
                   row_number() OVER (PARTITION BY object_id ORDER BY id DESC) AS rn
            FROM docs WHERE id > -1)
        WHERE rn = 1""",
    "fact_append": SQL_FACT_APPEND,
    "fact_dedup_append": with_("payments") + """
        SELECT DISTINCT card_num, transaction_amt, transaction_dt FROM payments
        WHERE transaction_dt >= TIMESTAMP '1997-06-01 00:00:00'
        EXCEPT
        SELECT card_num, transaction_amt, transaction_dt FROM payments
        WHERE transaction_dt < TIMESTAMP '1998-01-01 00:00:00'""",
    "distinct_rows": "SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem",
    "normalized_key_join": f"""
        SELECT o.o_orderkey, c.c_custkey FROM orders o
        JOIN customer c ON replace({_grouped_card('o.o_custkey')}, ' ', '') = {CARD16.format(k='c.c_custkey')}""",
    "csv_decimal_comma": """
        SELECT o_orderkey AS trans_id, CAST(o_orderdate AS DATE) AS trans_date,
               CAST(o_totalprice AS DECIMAL(12,2)) AS amount FROM orders""",
    "tsv_payments": with_("payments") + "SELECT transaction_dt, card_num, transaction_amt FROM payments",
    "tsv_payment_rejects": with_("payments") + """,
        p AS (SELECT l_orderkey, l_orderkey % 97 AS k, card_num, strftime(transaction_dt, '%d.%m.%Y %H:%M:%S') AS ts,
                     replace(CAST(transaction_amt AS VARCHAR), '.', ',') AS amount
              FROM payments WHERE l_orderkey % 97 < 5)
        SELECT l_orderkey,
               CASE k WHEN 0 THEN ' ' WHEN 1 THEN ts || chr(9) || card_num WHEN 2 THEN ts || chr(9) || card_num || chr(9) || 'n/a'
                      WHEN 3 THEN '31.02.x' || chr(9) || card_num || chr(9) || amount ELSE ts || chr(9) || chr(9) || amount END AS line,
               CASE k WHEN 0 THEN 'blank' WHEN 1 THEN 'fields' WHEN 2 THEN 'amount' WHEN 3 THEN 'time' ELSE 'key' END AS reason
        FROM p""",
    "xml_waybill": with_("waybills") + """
        SELECT waybill_num, driver_license, car_plate_num, work_start_dt, work_end_dt, issue_dt FROM waybills""",
    "file_date_from_name": """
        SELECT o_orderkey, 'transactions_' || strftime(o_orderdate, '%d%m%Y') || '.txt' AS file_name,
               CAST(o_orderdate AS DATE) AS file_dt FROM orders""",
    "pending_files": """
        WITH f AS (SELECT DISTINCT 'transactions_' || strftime(o_orderdate, '%d%m%Y') || '.txt' AS file_name,
                          CAST(o_orderdate AS DATE) AS file_dt
                   FROM orders WHERE CAST(o_orderdate AS DATE) > DATE '2001-01-01')
        SELECT file_name, file_dt, file_dt = (SELECT min(file_dt) FROM f) AS is_next FROM f""",
    "file_slice_dim": """
        SELECT s_suppkey AS terminal_id, CASE WHEN s_suppkey % 2 = 0 THEN 'POS' ELSE 'ATM' END AS terminal_type,
               'City' || CAST(s_nationkey AS VARCHAR) AS terminal_city, s_name AS terminal_address,
               TIMESTAMP '2024-03-01 00:00:00' AS update_dt
        FROM supplier""",
    "cumulative_file_delta": with_("blacklist") + """
        SELECT entry_dt, passport_num FROM blacklist WHERE entry_dt > DATE '2024-01-15'""",
})


# ------------------------------------------------------------------ streaming
ORACLE.update({
    "stream_file_ingest": with_("trans") + """
        SELECT trans_id, trans_date, card_num, oper_type, CAST(amt AS DECIMAL(10,2)) AS amt, oper_result, terminal
        FROM trans""",
    "stream_scd1_upsert": ORACLE["scd1_upsert"],
    "stream_payment_dedup": with_("payments") + """
        SELECT DISTINCT card_num, transaction_amt, transaction_dt FROM payments""",
    "stream_ride_assembly": with_("movement") + """
        SELECT ride AS ride_id,
               max(CASE WHEN event = 'READY' THEN dt END) AS ride_arrival_dt,
               max(CASE WHEN event = 'BEGIN' THEN dt END) AS ride_start_dt,
               max(CASE WHEN event IN ('END', 'CANCEL') THEN dt END) AS ride_end_dt,
               max(car_plate_num) AS car_plate_num
        FROM movement GROUP BY ride
        HAVING max(CASE WHEN event IN ('END', 'CANCEL') THEN dt END) IS NOT NULL""",
    "stream_scd2": with_("versions") + """
        SELECT c_custkey, c_acctbal, c_mktsegment, effective_from, effective_to, is_deleted FROM versions""",
    "stream_scd2_deletes": ORACLE["scd2_merge"],
})

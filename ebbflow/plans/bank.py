"""Bank warehouse marts: the card-fraud report (M1..M4) and its building blocks."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from ebbflow.functions.expr import concat_null_as_empty, plus_interval
from ebbflow.operators.scd2 import current
from ebbflow.operators.windows import DEFAULT_BUCKET_SECONDS, shift_within_key, within_horizon

FRAUD_COLS = ["event_dt", "passport", "fio", "phone", "event_type", "report_dt"]

# Fixed values of the transaction feed: operation results.
REJECT = "REJECT"
SUCCESS = "SUCCESS"


def client_card_star(accounts: DataFrame, clients: DataFrame, cards: DataFrame,
                     include_deleted: bool = True) -> DataFrame:
    """Card -> account -> client on current versions (CHAR blanks trimmed)."""
    acc = current(accounts, include_deleted).select("account_num", "client", F.col("valid_to").alias("account_valid_to"))
    cl = current(clients, include_deleted).select(
        "client_id", concat_null_as_empty("last_name", "first_name", "patronymic").alias("fio"),
        "passport_num", "passport_valid_to", "phone",
    )
    cr = current(cards, include_deleted).select(F.trim("card_num").alias("card_num"), "account_num")
    return (
        acc.join(cl, acc["client"] == cl["client_id"])
        .join(cr, "account_num")
        .select("card_num", "client_id", "fio", "passport_num", "passport_valid_to", "phone", "account_valid_to")
    )


def _since(trans: DataFrame, report_dt: str, lookback: str | None = None) -> DataFrame:
    """Operations a report from ``report_dt`` needs.  A rule that looks back
    at most ``lookback`` cannot use anything older (an older neighbour fails
    the time test anyway), so the scan is cut there - exact, and pushed into
    the Parquet scan - instead of reading the whole history every day."""
    start = F.lit(report_dt).cast("timestamp_ntz")
    if lookback:
        start = start - F.expr(f"INTERVAL {lookback}")
    return trans.filter(F.col("trans_date") >= start)


def _fraud_rows(df: DataFrame, event_type: int, passport: str = "passport_num") -> DataFrame:
    return df.select(
        F.col("trans_date").alias("event_dt"),
        F.col(passport).alias("passport"),
        "fio", "phone",
        F.lit(event_type).alias("event_type"),
        F.to_date("trans_date").alias("report_dt"),
    ).distinct()


def fraud_passport(trans: DataFrame, star: DataFrame, blacklist: DataFrame, report_dt: str) -> DataFrame:
    """M1: operation with an expired or blacklisted passport."""
    # the cumulative file repeats entries: "after any entry" == "after the first"
    bl = blacklist.groupBy(F.col("passport_num").alias("bl_passport")).agg(F.min("entry_dt").alias("entry_dt"))
    x = (
        trans.filter(F.col("trans_date") >= F.lit(report_dt).cast("timestamp_ntz"))
        .join(star, "card_num")
        .join(bl, F.col("passport_num") == F.col("bl_passport"), "left")
    )
    hit = (F.to_date("trans_date") > F.col("passport_valid_to")) | (
        F.col("bl_passport").isNotNull() & (F.col("trans_date") > F.col("entry_dt"))
    )
    x = x.filter(hit).withColumn("passport_out", F.coalesce("passport_num", "bl_passport"))
    return _fraud_rows(x, 1, "passport_out")


def fraud_contract(trans: DataFrame, star: DataFrame, report_dt: str) -> DataFrame:
    """M2: operation on an expired account contract."""
    x = trans.filter(F.col("trans_date") >= F.lit(report_dt).cast("timestamp_ntz")).join(star, "card_num")
    return _fraud_rows(x.filter(F.col("account_valid_to") < F.to_date("trans_date")), 2)


def _client_trans(trans: DataFrame, star: DataFrame) -> DataFrame:
    return trans.join(star.select("card_num", "client_id", "fio", "passport_num", "phone"), "card_num")


def _previous(cols: list[str], n: int) -> dict[str, Callable[[WindowSpec], Column]]:
    """``prev_{i}_{col}``: the values of the key's i-th operation before, for i in 1..n."""
    return {f"prev_{i}_{c}": lambda w, i=i, c=c: F.lag(c, i).over(w) for i in range(1, n + 1) for c in cols}


def fraud_two_cities(trans: DataFrame, star: DataFrame, terminals: DataFrame, report_dt: str,
                     window: str = "1 hour", bucket_seconds: int = DEFAULT_BUCKET_SECONDS) -> DataFrame:
    """M3: an operation in another city than the client's previous operation
    within ``window``; the later operation is reported.  Operations at
    terminals of unknown city take no part: the one before them counts."""
    term = current(terminals).select(F.col("terminal_id").alias("terminal"), "terminal_city")
    x = _client_trans(_since(trans, report_dt, window), star).join(term.filter(F.col("terminal_city").isNotNull()), "terminal")
    x = within_horizon(x, ["client_id"], ["trans_date", "trans_id"], _seconds(window), _previous(["terminal_city", "trans_date"], 1),
                       bucket_seconds=bucket_seconds)
    hit = (
        (F.col("terminal_city") != F.col("prev_1_terminal_city"))
        & (F.col("trans_date") <= plus_interval("prev_1_trans_date", window))
        & (F.col("trans_date") >= F.lit(report_dt).cast("timestamp_ntz"))
    )
    return _fraud_rows(x.filter(hit), 3)


def fraud_amount_guessing(trans: DataFrame, star: DataFrame, report_dt: str, window: str = "20 minutes",
                          chain: int = 4, bucket_seconds: int = DEFAULT_BUCKET_SECONDS) -> DataFrame:
    """M4: ``chain`` operations within ``window``, amounts strictly
    decreasing, all rejected but the last, which succeeds; the final
    (successful) operation is reported."""
    n = chain - 1
    x = within_horizon(_client_trans(_since(trans, report_dt, window), star), ["client_id"], ["trans_date", "trans_id"],
                       _seconds(window), _previous(["trans_date", "amt", "oper_result"], n), bucket_seconds=bucket_seconds)
    hit = (F.col("oper_result") == SUCCESS) & (F.col("trans_date") >= F.lit(report_dt).cast("timestamp_ntz"))
    hit = hit & (F.col("trans_date") <= plus_interval(f"prev_{n}_trans_date", window))
    amt_prev = "amt"
    for i in range(1, n + 1):
        hit = hit & (F.col(f"prev_{i}_oper_result") == REJECT) & (F.col(f"prev_{i}_amt") > F.col(amt_prev))
        amt_prev = f"prev_{i}_amt"
    return _fraud_rows(x.filter(hit), 4)


def fraud_mart(trans, star, blacklist, terminals, report_dt: str, window_two_cities="1 hour",
               window_guessing="20 minutes", bucket_seconds: int = DEFAULT_BUCKET_SECONDS) -> DataFrame:
    """M4u: the four rules in one report table, in one pass: one star join,
    one ordered window over the longest look-back, each operation flagged per
    rule and exploded into one report row per rule it breaks."""
    term = current(terminals).select(F.col("terminal_id").alias("terminal"), "terminal_city")
    bl = blacklist.groupBy(F.col("passport_num").alias("bl_passport")).agg(F.min("entry_dt").alias("entry_dt"))
    horizon = _seconds(window_two_cities, window_guessing)
    lookback = f"{horizon} seconds"
    x = (_since(trans, report_dt, lookback).join(star, "card_num").join(term, "terminal", "left")
         .join(bl, F.col("passport_num") == F.col("bl_passport"), "left"))
    city = F.when(F.col("terminal_city").isNotNull(), F.struct("terminal_city", "trans_date"))
    known = {"known": lambda w: F.last(city, ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, -1))}
    x = within_horizon(x, ["client_id"], ["trans_date", "trans_id"], horizon,
                       _previous(["trans_date", "amt", "oper_result"], 3) | known, bucket_seconds=bucket_seconds)
    day = F.to_date("trans_date")
    r1 = (day > F.col("passport_valid_to")) | (F.col("bl_passport").isNotNull() & (F.col("trans_date") > F.col("entry_dt")))
    r2 = F.col("account_valid_to") < day
    r3 = ((F.col("terminal_city") != F.col("known.terminal_city"))
          & (F.col("trans_date") <= plus_interval("known.trans_date", window_two_cities)))
    r4 = (F.col("oper_result") == SUCCESS) & (F.col("trans_date") <= plus_interval("prev_3_trans_date", window_guessing))
    amt_prev = "amt"
    for i in range(1, 4):
        r4 = r4 & (F.col(f"prev_{i}_oper_result") == REJECT) & (F.col(f"prev_{i}_amt") > F.col(amt_prev))
        amt_prev = f"prev_{i}_amt"
    rules = F.array(*[F.when(r, F.lit(k)) for k, r in ((1, r1), (2, r2), (3, r3), (4, r4))])
    x = x.filter(F.col("trans_date") >= F.lit(report_dt).cast("timestamp_ntz"))
    x = x.select("trans_date", F.coalesce("passport_num", "bl_passport").alias("passport_num"), "fio", "phone",
                 F.explode(rules).alias("_rule")).filter(F.col("_rule").isNotNull())
    return x.select(
        F.col("trans_date").alias("event_dt"), F.col("passport_num").alias("passport"), "fio", "phone",
        F.col("_rule").alias("event_type"), F.to_date("trans_date").alias("report_dt"),
    ).distinct()


def _seconds(*intervals: str) -> int:
    """Largest of some interval literals ('1 hour', '20 minutes'), in seconds."""
    unit = {"second": 1, "minute": 60, "hour": 3600, "day": 86400}
    out = 0
    for iv in intervals:
        num, u = iv.split()
        out = max(out, int(num) * unit[u.lower().rstrip("s")])
    return out


def lead_default(trans: DataFrame, star: DataFrame, terminals: DataFrame,
                 bucket_seconds: int = DEFAULT_BUCKET_SECONDS) -> DataFrame:
    """Next city and time of the client's operations, defaulting to self."""
    term = current(terminals).select(F.col("terminal_id").alias("terminal"), "terminal_city")
    x = _client_trans(trans, star).join(term, "terminal", "left")
    x = shift_within_key(x, ["client_id"], ["trans_date", "trans_id"], ["terminal_city", "trans_date"], 1,
                         prefix="lead", bucket_seconds=bucket_seconds)
    return x.select(
        "trans_id", "client_id", "terminal_city",
        F.coalesce("lead_1_terminal_city", "terminal_city").alias("next_city"),
        "trans_date",
        F.coalesce("lead_1_trans_date", "trans_date").alias("next_dt"),
    )


def lead_chain(trans: DataFrame, star: DataFrame, n: int = 3,
               bucket_seconds: int = DEFAULT_BUCKET_SECONDS) -> DataFrame:
    """Lead 1..n over three columns sharing one ordering."""
    cols = ["trans_date", "amt", "oper_result"]
    x = shift_within_key(_client_trans(trans, star), ["client_id"], ["trans_date", "trans_id"], cols, n,
                         prefix="lead", bucket_seconds=bucket_seconds)
    out = [F.col("trans_id"), F.col("client_id")] + [F.col(c) for c in cols]
    for c in cols:
        for i in range(1, n + 1):
            out.append(F.coalesce(f"lead_{i}_{c}", c).alias(f"lead_{c}_{i}"))
    return x.select(*out)

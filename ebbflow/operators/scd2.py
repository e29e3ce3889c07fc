"""Type 2 slowly changing dimensions.

A dimension is a DataFrame with the business key columns, the tracked
attribute columns and ``effective_from``, ``effective_to``, ``is_deleted``
(optionally a surrogate key column).  The open version of a key has
``effective_to = OPEN_END`` (or the ``end`` given); an old version ends ``gap`` before its
successor starts.

Parquet has no UPDATE/MERGE, so :func:`scd2_merge` returns the complete new
dimension snapshot; closed versions pass through untouched and callers
write the snapshot as a new table version (see ``ebbflow.sinks``).
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ebbflow.functions.expr import CLOSE_GAP, OPEN_END, minus_interval, open_end, ts_literal
from ebbflow.operators.windows import DEFAULT_BUCKET_SECONDS, shift_within_key

META = ["effective_from", "effective_to", "is_deleted"]


def is_open(col: str = "effective_to", end: str = OPEN_END) -> Column:
    return F.col(col) == open_end(end)


def current(dim: DataFrame, include_deleted: bool = True, end: str = OPEN_END) -> DataFrame:
    """H7: open versions (tombstones included unless ``include_deleted=False``)."""
    out = dim.filter(is_open(end=end))
    return out if include_deleted else out.filter(~F.col("is_deleted"))


def _same(cols: Sequence[str], a: str, b: str) -> Column:
    out = F.lit(True)
    for c in cols:
        out = out & F.col(f"{a}{c}").eqNullSafe(F.col(f"{b}{c}"))
    return out


# ------------------------------------------------------------------ H1..H5
def new_keys(dim: DataFrame, stg: DataFrame, keys: Sequence[str], tracked: Sequence[str],
             change_ts: str = "change_ts", end: str = OPEN_END) -> DataFrame:
    """H1: staged keys without an open, live version open a first version."""
    live_open = current(dim, include_deleted=False, end=end).select(*keys)
    return stg.join(live_open, list(keys), "left_anti").select(
        *keys, *tracked,
        F.col(change_ts).alias("effective_from"), open_end(end).alias("effective_to"), F.lit(False).alias("is_deleted"),
    )


def changes(dim: DataFrame, stg: DataFrame, keys: Sequence[str], tracked: Sequence[str],
            change_ts: str = "change_ts", end: str = OPEN_END) -> DataFrame:
    """H2: staged rows whose tracked values differ (null-safe) from the open version."""
    o = current(dim, include_deleted=False, end=end).select(*keys, *[F.col(c).alias(f"prev_{c}") for c in tracked], "effective_from")
    j = stg.join(o, list(keys), "inner")
    changed = ~_same(tracked, "", "prev_")
    return j.filter(changed & (F.col(change_ts) > F.col("effective_from"))).select(
        *keys, *tracked, *[f"prev_{c}" for c in tracked], F.col(change_ts).alias("change_ts")
    )


def close_changed(dim: DataFrame, stg: DataFrame, keys: Sequence[str], tracked: Sequence[str],
                  change_ts: str = "change_ts", gap: str = CLOSE_GAP, end: str = OPEN_END) -> DataFrame:
    """H3: the open versions that a change closes, with their new end."""
    ch = changes(dim, stg, keys, tracked, change_ts, end).select(*keys, "change_ts")
    o = current(dim, include_deleted=False, end=end)
    return o.join(ch, list(keys)).withColumn("effective_to", minus_interval("change_ts", gap)).drop("change_ts")


def reopen_changed(dim: DataFrame, stg: DataFrame, keys: Sequence[str], tracked: Sequence[str],
                   change_ts: str = "change_ts", end: str = OPEN_END) -> DataFrame:
    """H4: replacement versions opened by a change."""
    ch = changes(dim, stg, keys, tracked, change_ts, end)
    return ch.select(
        *keys, *tracked, F.col("change_ts").alias("effective_from"),
        open_end(end).alias("effective_to"), F.lit(False).alias("is_deleted"),
    )


def tombstones(dim: DataFrame, live_keys: DataFrame, keys: Sequence[str], batch_ts: str,
               gap: str = CLOSE_GAP, end: str = OPEN_END) -> DataFrame:
    """H5: open live versions whose key left the source: close + tombstone."""
    gone = current(dim, include_deleted=False, end=end).join(live_keys.select(*keys), list(keys), "left_anti")
    closed = gone.withColumn("effective_to", minus_interval(ts_literal(batch_ts), gap))
    tomb = gone.withColumn("effective_from", ts_literal(batch_ts)).withColumn("is_deleted", F.lit(True))
    return closed.unionByName(tomb)


# ------------------------------------------------------------------ H6
def scd2_merge(
    dim: DataFrame,
    stg: DataFrame,
    keys: Sequence[str],
    tracked: Sequence[str],
    *,
    change_ts: str = "change_ts",
    tiebreak: str | None = None,
    live_keys: DataFrame | None = None,
    batch_ts: str | None = None,
    gap: str = CLOSE_GAP,
    surrogate: str | None = None,
    end: str = OPEN_END,
    split: bool = False,
):
    """H6: apply a staged batch (and optionally a full key snapshot) to ``dim``.

    Returns the new dimension; with ``split=True`` a pair (closed history
    passed through unchanged, rows derived from the open versions) so a
    writer can append only what changed (``sinks.tables.write_dimension``).

    * several staged rows per key are chained by change time; consecutive
      identical rows collapse (D15); of rows with the same change time the one
      with the largest ``tiebreak`` (then value hash) counts;
    * staged rows not newer than the open version are ignored (replays);
      :func:`late_changes` returns those that are no replays;
    * a staged row equal (null-safe) to the open version is a no-op;
    * a key whose open version is a tombstone is reopened (D14);
    * with ``live_keys``, every key whose latest version is live but absent
      from the snapshot is closed at ``batch_ts - gap`` and gets a tombstone,
      also after a change in the same batch (close, reopen, tombstone);
    * a version never ends before it starts, however close the next one is;
    * with ``surrogate``, later versions carry the key's surrogate id and new
      keys get fresh dense ids (H8).

    Open versions, staged rows and live keys are tagged and united, so one
    exchange on the key serves every step; staged rows are reduced to one per
    key and time before it.  Business keys and change times must be non-NULL
    (filter or repair such rows upstream; a NULL key cannot identify a version).
    """
    keys, tracked = list(keys), list(tracked)
    if live_keys is not None and batch_ts is None:
        raise ValueError("batch_ts is required with live_keys")
    closed, open_ = dim.filter(~is_open(end=end)), dim.filter(is_open(end=end))
    sk_cols = [surrogate] if surrogate else []
    out_cols = keys + tracked + META + sk_cols

    # 1. one ordered list per key: snapshot mark, open version, staged rows
    staged = _one_per_time(stg, keys, tracked, change_ts, tiebreak)
    rows = open_.select(*keys, *tracked, F.col("effective_from").alias("_ts"), "is_deleted", *sk_cols, F.lit(0).alias("_src"))
    rows = rows.unionByName(staged.select("*", F.lit(False).alias("is_deleted"), F.lit(1).alias("_src")), allowMissingColumns=True)
    if live_keys is not None:
        rows = rows.unionByName(live_keys.select(*keys, F.lit(-1).alias("_src")), allowMissingColumns=True)
    by_key = Window.partitionBy(*keys).orderBy("_src", "_ts")
    so_far = by_key.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    is_src = {n: F.col("_src") == n for n in (-1, 0, 1)}
    rows = rows.select(
        "*",
        F.max(is_src[-1]).over(so_far).alias("_live"),
        F.first(F.when(is_src[0], F.struct("_ts", "is_deleted", *tracked, *sk_cols)), ignorenulls=True).over(so_far).alias("_o"),
        F.lag(F.when(is_src[1], F.struct("_ts", *tracked))).over(by_key).alias("_p"),
    )

    # 2. staged rows that make a version: newer than the open one, different
    #    from the staged row before them or, if they come first, from the open one
    def newer(ts: str) -> Column:
        return F.col("_o").isNull() | (F.col(ts) > F.col("_o._ts"))

    after_staged = F.col("_p").isNotNull() & newer("_p._ts")
    same_prev = after_staged & _same(tracked, "", "_p.")
    same_open = ~after_staged & F.col("_o").isNotNull() & ~F.col("_o.is_deleted") & _same(tracked, "", "_o.")
    rows = rows.filter(is_src[0] | (is_src[1] & newer("_ts") & ~same_prev & ~same_open))

    # 3. a version ends `gap` before the next one starts; the last stays open
    following = F.lead("_ts").over(by_key)
    rows = rows.select(
        *keys, *tracked, F.col("_ts").alias("effective_from"),
        F.when(following.isNull(), open_end(end)).otherwise(F.greatest("_ts", minus_interval(following, gap))).alias("effective_to"),
        "is_deleted", *[F.coalesce(c, f"_o.{c}").alias(c) for c in sk_cols], "_live",
    )

    # 4. surrogate ids for keys seen for the first time (dense, key order)
    if surrogate:
        new_k = stg.select(*keys).distinct().join(open_.select(*keys), keys, "left_anti")
        ids = assign_surrogate_keys(new_k, keys, "_new_sk", base=dim.agg(F.max(surrogate)))
        rows = rows.join(ids, keys, "left").withColumn(surrogate, F.coalesce(F.col(surrogate), F.col("_new_sk")))

    # 5. logical deletes against the full key snapshot
    rows = _apply_deletes(rows, out_cols, batch_ts, gap, end) if live_keys is not None else rows.select(*out_cols)
    if split:
        return closed.select(*out_cols), rows
    return closed.select(*out_cols).unionByName(rows)


def _one_per_time(stg: DataFrame, keys: list[str], tracked: list[str], change_ts: str, tiebreak: str | None) -> DataFrame:
    """Staged rows reduced to one per key and change time (a map-side partial aggregate)."""
    order = [F.col(tiebreak).alias("_tie")] if tiebreak else []
    last = F.max(F.struct(*order, F.xxhash64(*tracked).alias("_hash"), *tracked)).alias("_last")
    return stg.groupBy(*keys, F.col(change_ts).alias("_ts")).agg(last).select(
        *keys, *[F.col(f"_last.{c}").alias(c) for c in tracked], "_ts")


def late_changes(dim: DataFrame, stg: DataFrame, keys: Sequence[str], tracked: Sequence[str], change_ts: str = "change_ts",
                 end: str = OPEN_END) -> DataFrame:
    """Staged rows that the merge ignores as too old and that no version of
    ``dim`` accounts for: neither one that starts at their time nor one with
    the same values that was valid then."""
    keys, tracked = list(keys), list(tracked)
    opened = current(dim, end=end).select(*keys, F.col("effective_from").alias("_of"))
    old = stg.join(opened, keys).filter(F.col(change_ts) <= F.col("_of")).drop("_of")
    v = dim.select(*[F.col(k).alias(f"_v_{k}") for k in keys], *[F.col(c).alias(f"_v_{c}") for c in tracked],
                   F.col("effective_from").alias("_v_from"), F.col("effective_to").alias("_v_to"))
    same_key = [F.col(k) == F.col(f"_v_{k}") for k in keys]
    known = (F.col(change_ts) == F.col("_v_from")) | (F.col(change_ts).between(F.col("_v_from"), F.col("_v_to")) & _same(tracked, "", "_v_"))
    return old.join(v, [*same_key, known], "left_anti")


def _apply_deletes(rows: DataFrame, out_cols: list[str], batch_ts: str, gap: str, end: str) -> DataFrame:
    """The open live version of a key without ``_live`` is closed at
    ``batch_ts - gap`` and followed by a tombstone (explode: one pass over ``rows``)."""
    gone = is_open(end=end) & ~F.col("is_deleted") & ~F.col("_live")
    now = ts_literal(batch_ts)
    as_is = F.struct(*[F.col(c) for c in out_cols])
    ended = F.greatest("effective_from", minus_interval(now, gap))
    closed_now = F.struct(*[ended.alias(c) if c == "effective_to" else F.col(c) for c in out_cols])
    tomb = F.struct(*[now.alias(c) if c == "effective_from" else F.lit(True).alias(c) if c == "is_deleted"
                      else F.col(c) for c in out_cols])
    return rows.select(F.explode(F.when(gone, F.array(closed_now, tomb)).otherwise(F.array(as_is))).alias("_r")
                       ).select(*[F.col(f"_r.{c}").alias(c) for c in out_cols])


# ------------------------------------------------------------------ H8
def assign_surrogate_keys(new_keys: DataFrame, keys: Sequence[str], name: str, *, base: DataFrame | int = 0,
                          ranges: int = 256) -> DataFrame:
    """Dense ids ``base+1 ..`` for distinct keys, in key order, without a single-partition window over the keys.

    Keys are dealt into ``ranges`` ranges, numbered inside each, and each range goes on from the sizes of those before
    it.  The ranges' bounds are a sample of the keys (of every hash class the key with the smallest hash), so they
    depend on the keys alone: a retried or recomputed task numbers alike.  Nothing runs before the result is
    used: bounds and ``base`` (a DataFrame of one value, NULL: 0) are scalar subqueries.  Both the sample and the table of
    sizes have at most ``ranges`` rows."""
    keys = list(keys)
    key = F.struct(*keys)
    new_keys = new_keys.select(*keys)
    h = F.xxhash64(*keys, F.lit(1))
    sample = new_keys.groupBy(F.pmod(F.xxhash64(*keys), F.lit(ranges)).alias("_c")).agg(F.min_by(key, h).alias("_k"))
    bounds = sample.agg(F.sort_array(F.collect_list("_k")).alias("_bounds"))
    # the key's place among the bounds
    ranged = new_keys.withColumn("_r", F.array_position(F.sort_array(F.array_append(bounds.scalar(), key)), key))
    sizes = ranged.groupBy("_r").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_r").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_r", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_off"))
    place = F.row_number().over(Window.partitionBy("_r").orderBy(*keys))
    start = F.coalesce(base.scalar(), F.lit(0)) if isinstance(base, DataFrame) else F.lit(base)
    return ranged.withColumn("_i", place).join(F.broadcast(offsets), "_r").select(
        *keys, (start + F.col("_off") + F.col("_i")).cast("long").alias(name))


# ------------------------------------------------------------------ H9
def history_from_events(events: DataFrame, keys: Sequence[str], attrs: Sequence[str], ts: str,
                        tiebreak: str, *, gap: str = CLOSE_GAP, end: str = OPEN_END,
                        bucket_seconds: int = DEFAULT_BUCKET_SECONDS) -> DataFrame:
    """H9: attribute history from an event log.

    The last value per (key, ts) wins (ties broken by ``tiebreak``), runs of
    equal values collapse, each version ends ``gap`` before the next starts.
    """
    keys, attrs = list(keys), list(attrs)
    last = events.groupBy(*keys, ts).agg(
        F.max(F.struct(F.col(tiebreak), *[F.col(a) for a in attrs])).alias("_last")
    ).select(*keys, ts, *[F.col(f"_last.{a}").alias(a) for a in attrs])
    last = last.withColumn("_one", F.lit(1))
    lagged = shift_within_key(last, keys, [ts], attrs + ["_one"], 1, lag=True, prefix="_p",
                              bucket_seconds=bucket_seconds)
    first = F.col("_p_1__one").isNull()
    same = F.lit(True)
    for a in attrs:
        same = same & F.col(a).eqNullSafe(F.col(f"_p_1_{a}"))
    kept = lagged.filter(first | ~same).select(*keys, *attrs, ts)
    nxt = shift_within_key(kept, keys, [ts], [ts], 1, prefix="_n", bucket_seconds=bucket_seconds)
    return nxt.select(
        *keys, *attrs,
        F.col(ts).alias("effective_from"),
        F.when(F.col(f"_n_1_{ts}").isNull(), open_end(end))
        .otherwise(F.greatest(F.col(ts).cast("timestamp_ntz"), minus_interval(F.col(f"_n_1_{ts}").cast("timestamp_ntz"), gap)))
        .alias("effective_to"),
    )

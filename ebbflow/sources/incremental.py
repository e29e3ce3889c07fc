"""Incremental reads driven by a high-water mark.

The watermark is a literal (collected once from the small control table),
so the comparison reaches the Parquet/JDBC scan as a pushed filter.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _lit_ts(wm) -> Column:
    return F.lit(wm).cast("timestamp_ntz") if isinstance(wm, str) else F.lit(wm)


def incremental_scan(df: DataFrame, col: str, wm) -> DataFrame:
    """Rows changed after the watermark (``col > wm``)."""
    return df.filter(F.col(col) > _lit_ts(wm))


def incremental_scan_coalesced(df: DataFrame, update_col: str, create_col: str, wm,
                               change_col: str = "change_dt") -> DataFrame:
    """Rows with ``coalesce(update, create) > wm``.

    Written as ``update > wm OR (update IS NULL AND create > wm)`` so both
    comparisons are pushed to the scan (``coalesce`` is not)."""
    w = _lit_ts(wm)
    upd, crt = F.col(update_col), F.col(create_col)
    return df.filter((upd > w) | (upd.isNull() & (crt > w))).withColumn(change_col, F.coalesce(upd, crt))


def key_snapshot(df: DataFrame, keys: Sequence[str], exclude: Column | None = None) -> DataFrame:
    """S3: the full list of live keys (a key-only scan after pruning).

    ``exclude`` drops rows that are present but retired, e.g.
    ``F.col("finished_flg") == "Y"`` for cars taken out of service (D27), so
    the SCD2 merge tombstones them."""
    if exclude is not None:
        df = df.filter(~exclude)
    return df.select(*keys).distinct()


def batch_pull(df: DataFrame, ts_col: str, id_col: str, wm, limit: int | None = None, include_ties: bool = True) -> DataFrame:
    """The next batch after ``wm`` in (ts, id) order, at most ``limit`` rows;
    without a limit, all rows after ``wm``.

    With ``include_ties`` (default) the batch is widened to every row whose
    ts equals the ts of the last row, so a strict ``> wm`` on the next run
    cannot skip the rest of a tie.  The cut-off ts comes from a top-n
    (partial top-n per partition, then one merge of ``limit`` rows)."""
    after = df.filter(F.col(ts_col) > _lit_ts(wm))
    if limit is None:
        return after
    if not include_ties:
        return after.orderBy(ts_col, id_col).limit(limit)
    cut = after.select(ts_col, id_col).orderBy(ts_col, id_col).limit(limit).agg(F.max(ts_col).alias("m")).collect()[0]["m"]
    if cut is None:
        return after.limit(0)
    if hasattr(cut, "isoformat"):
        # literal text keeps the exact TIMESTAMP_NTZ value (no local time zone)
        return after.filter(F.col(ts_col) <= F.lit(cut.isoformat(sep=" ")).cast("timestamp_ntz"))
    return after.filter(F.col(ts_col) <= F.lit(cut))


def json_extract_batch(df: DataFrame, id_col: str, wm: int, json_col: str, fields: dict[str, str],
                       limit: int | None = None, key_col: str | None = None) -> DataFrame:
    """Staged JSON rows with ``id > wm``, fields extracted with
    ``get_json_object``; with ``key_col`` only the latest row (highest id)
    of each key; with ``limit`` the first rows by id, else all."""
    from ebbflow.operators.scd1 import latest_per_key

    x = df.filter(F.col(id_col) > F.lit(wm)).select(
        id_col, *([key_col] if key_col else []),
        *[F.get_json_object(F.col(json_col), path).alias(name) for name, path in fields.items()],
    )
    if key_col:
        x = latest_per_key(x, [key_col], [id_col])
    return x if limit is None else x.orderBy(id_col).limit(limit)

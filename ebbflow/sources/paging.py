"""S11/O2 and S12 with D30: keyset pagination on (change time, id).

A cursor is the pair (time, id) of the last row taken.  The next page holds the rows after it in (time, id)
order, so a page may end in the middle of rows with equal times, and a document that changes keeps its id but moves behind the
cursor with its new time (D30).  The rows behind the cursor are read and ordered once for all their pages; pages are
committed one by one together with their cursor, and a pull that stops goes on where it was.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ebbflow.operators.scd1 import latest_per_key
from ebbflow.sinks import tables


@dataclass(frozen=True)
class Cursor:
    """Position after a row: its change time (text, exact to the microsecond) and id."""

    ts: str
    id: int | None = None

    def after(self, ts_col: str, id_col: str) -> Column:
        """Rows behind the cursor; without an id, rows with a later time.

        The first test is a plain comparison with a literal, so it reaches the scan.
        """
        t = F.lit(self.ts).cast("timestamp_ntz")
        ts, known = F.col(ts_col), F.col(id_col).isNotNull()
        if self.id is None:
            return (ts > t) & known
        return (ts >= t) & ((ts > t) | (F.col(id_col) > F.lit(self.id))) & known


def next_page(df: DataFrame, ts_col: str, id_col: str, cursor: Cursor, page_size: int | None) -> DataFrame:
    """The next ``page_size`` rows behind the cursor (a top-n per partition, then one merge of a page); None: all of them."""
    rows = df.filter(cursor.after(ts_col, id_col))
    return rows if page_size is None else rows.orderBy(ts_col, id_col).limit(page_size)


def last_position(page: DataFrame, ts_col: str, id_col: str) -> Cursor | None:
    """The cursor behind a page; None for an empty page."""
    last = page.agg(F.max(F.struct(F.col(ts_col).alias("ts"), F.col(id_col).alias("id"))).alias("c")).first().c
    return None if last is None else Cursor(last.ts.isoformat(sep=" "), last.id)


def drain(df: DataFrame, root: str, name: str, ts_col: str, id_col: str, start: Cursor, page_size: int | None,
          max_pages: int | None = None) -> int:
    """Take page after page into ``<root>/<name>/batch=<n>`` until none is left; returns how many pages were taken.

    A round reads the source once and cuts the rows behind the cursor into pages; rows that came meanwhile are the next
    round's, and a round without rows ends the pull.  Each page is committed with its cursor, in one manifest, in order;
    a pull that was stopped goes on behind the last committed page (pages written beyond it are overwritten).  Rows
    without a change time or id are never behind a cursor and are not taken.  ``(ts_col, id_col)`` must be unique.
    """
    spark = df.sparkSession
    done = 0
    while max_pages is None or done < max_pages:
        cursor, page_no = _resume(spark, root, name, start)
        if page_size is None:
            path = f"{root}/{name}"
            tables.append_batch(next_page(df, ts_col, id_col, cursor, None), path, page_no)
            last = last_position(spark.read.schema(df.schema).parquet(f"{path}/batch={page_no:012d}"), ts_col, id_col)
            if last is not None:
                tables.commit(spark, root, page_no, *_published(name, page_no, last))
            return int(last is not None)
        rows = next_page(df, ts_col, id_col, cursor, None if max_pages is None else (max_pages - done) * page_size)
        taken = _round(rows, root, name, ts_col, id_col, page_no, page_size)
        if not taken:
            break
        done += taken
    return done


def _published(name: str, page_no: int, last: Cursor) -> tuple[dict[str, int], dict[str, str]]:
    """Tables and watermarks of a page's manifest."""
    return {name: page_no}, {f"{name}.ts": last.ts, f"{name}.id": str(last.id)}


def _round(rows: DataFrame, root: str, name: str, ts_col: str, id_col: str, first: int, page_size: int) -> int:
    """Write ``rows`` as the pages from ``first`` on and commit them in order; returns how many.

    The rows are written once in (time, id) ranges; a row's place is its place in its range, behind the sizes of the
    ranges before it (a table of at most as many rows as there are shuffle partitions).
    """
    spark, kept = rows.sparkSession, f"{root}/_ordered/{name}"
    at = F.monotonically_increasing_id()  # the range in the upper bits, the place in it in the lower 33
    rows.repartitionByRange(ts_col, id_col).sortWithinPartitions(ts_col, id_col).withColumn("_at", at) \
        .write.mode("overwrite").parquet(kept)
    ordered = spark.read.schema(T.StructType([*rows.schema.fields, T.StructField("_at", T.LongType())])).parquet(kept) \
        .withColumn("_range", F.shiftright("_at", 33)).withColumn("_place", F.col("_at").bitwiseAND(F.lit((1 << 33) - 1)))
    sizes = sorted(map(tuple, ordered.groupBy("_range").count().collect()))
    if sizes:
        offsets, total = [], 0
        for r, n in sizes:
            offsets.append((r, total))
            total += n
        placed = ordered.join(F.broadcast(spark.createDataFrame(offsets, "_range long, _before long")), "_range") \
            .withColumn("_row", F.col("_before") + F.col("_place"))
        page = F.floor(F.col("_row") / F.lit(page_size)).cast("long") + F.lit(first)
        tables.append_batches(placed.select(*rows.columns, page.alias("batch")), f"{root}/{name}")
        ends = placed.filter(((F.col("_row") + 1) % page_size == 0) | (F.col("_row") == total - 1)) \
            .select("_row", F.col(ts_col).alias("ts"), F.col(id_col).alias("id")).orderBy("_row")
        tables.commit_each(spark, root, ((n, *_published(name, n, Cursor(e.ts.isoformat(sep=" "), e.id)))
                                         for n, e in enumerate(ends.toLocalIterator(), first)))
    tables.delete(spark, kept)
    return -(-total // page_size) if sizes else 0


def _resume(spark: SparkSession, root: str, name: str, start: Cursor) -> tuple[Cursor, int]:
    """The committed cursor of ``name`` (or ``start``), and the number of the next page."""
    m = tables.latest_manifest(spark, root)
    marks = (m["watermarks"] or {}) if m is not None else {}
    version = 0 if m is None else m["version"]
    if f"{name}.ts" not in marks:
        return start, version + 1
    return Cursor(marks[f"{name}.ts"], int(marks[f"{name}.id"])), version + 1


def pulled(spark: SparkSession, root: str, name: str, schema: str) -> DataFrame:
    """The rows of all committed pages."""
    m = tables.latest_manifest(spark, root)
    upto = (m["tables"] or {}).get(name, 0) if m is not None else 0
    return tables.read_appended(spark, f"{root}/{name}", schema, before_batch=upto + 1)


def changed_documents(df: DataFrame, ts_col: str, id_col: str, cursor: Cursor, json_col: str, fields: dict[str, str],
                      key: Sequence[str], page_size: int | None = None) -> DataFrame:
    """S12 with D30: the documents behind the cursor, JSON fields extracted, the newest row of each key."""
    page = next_page(df, ts_col, id_col, cursor, page_size)
    rows = page.select(id_col, ts_col, *[k for k in key if k not in (id_col, ts_col)],
                       *[F.get_json_object(F.col(json_col), path).alias(n) for n, path in fields.items()])
    return latest_per_key(rows, list(key), [c for c in (ts_col, id_col) if c not in key])

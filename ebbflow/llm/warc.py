"""Deterministic sharded WARC writer and reader.

Records are sorted by page id into ranges.  The ranges' bounds are quantiles of the ids
with the smallest hashes (a bounded sample), so they depend on the data alone.  Each
range is written in order, one gzip member per record, and a file is rolled once its
compressed size reaches ``file_bytes``.  Headers are made anew from the record: ids from
page id, digests from the payload, lengths from the bytes written.  A task writes under a
temporary name that no other attempt uses; the driver moves the files of the attempts
that Spark accepted to their final names and writes the manifest (Parquet) last, so
readers that go by the manifest see all of an archive or nothing.

Of records with equal payloads of at least ``dedup_bytes`` bytes, the one with the largest
page id is the response, the others are revisits of it; smaller payloads are responses.

Nulls and edge cases: a null html is an empty payload, a null url an empty URI; a null page id
sorts first, is always a response and comes back null; of rows with one page id and one payload one is the
response and the others revisit it; an empty table gives an archive without files; other
columns are ignored.  Files are reached through ``pyarrow.fs``, so the archive's folder
must be one that the executors share.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import json
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ebbflow.llm import core

FILE_BYTES = 64 << 20
SAMPLE = 20_000
DEDUP_BYTES = 1_000
DATE = "2000-01-01T00:00:00Z"
_NAMESPACE = uuid.UUID("6ba7b811-9dad-11d1-80b4-00c04fd430c8")  # fixed value: the standard URL namespace
WRITTEN = "shard long, part long, temp string, n_records long, n_bytes long, sha256 string"
OUT = "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long"


def _filesystem(path: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (fs.LocalFileSystem(), path)


def _record(headers: list[tuple[str, str]], block: bytes) -> bytes:
    sha1 = base64.b32encode(hashlib.sha1(block).digest()).decode()
    lines = [f"{k}: {v}" for k, v in [*headers, ("WARC-Block-Digest", f"sha1:{sha1}"), ("Content-Length", str(len(block)))]]
    return ("WARC/1.1\r\n" + "\r\n".join(lines) + "\r\n\r\n").encode() + block + b"\r\n\r\n"


def _record_id(page: int | None, copy: int) -> str:
    return f"<urn:uuid:{uuid.uuid5(_NAMESPACE, f'page:{page}:{copy}')}>"


def page_record(page: int | None, url: str, payload: bytes, refers_to: int | None, copy: int) -> bytes:
    """A response, or (``refers_to``) a revisit without the payload; ``copy`` numbers the rows of a page id."""
    uri = "".join(c for c in url if c.isprintable())
    digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    head = [("WARC-Type", "response" if refers_to is None else "revisit"), ("WARC-Record-ID", _record_id(page, copy)), ("WARC-Date", DATE),
            ("WARC-Target-URI", uri), ("WARC-Payload-Digest", f"sha1:{digest}"), ("Content-Type", "application/http; msgtype=response"),
            ("X-Page-Id", "" if page is None else str(page))]
    if refers_to is not None:
        head += [("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"),
                 ("WARC-Refers-To", _record_id(refers_to, 0)), ("X-Refers-To-Page-Id", str(refers_to))]
    return _record(head, http if refers_to is not None else http + payload)


def write_archive(pages: DataFrame, path: str, id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
                  file_bytes: int = FILE_BYTES, shard_bytes: int = 256 << 20, dedup_bytes: int = DEDUP_BYTES) -> DataFrame:
    """Write the archive below ``path`` and return its manifest."""
    spark = pages.sparkSession
    src = pages.select(pages[id_col].cast("long").alias("page_id"), F.coalesce(pages[url_col].cast("string"), F.lit("")).alias("url"),
                       F.coalesce(F.encode(pages[html_col].cast("string"), "UTF-8"), F.lit(b"")).alias("payload"))
    narrow = src.select("page_id", F.octet_length("payload").cast("long").alias("n"), F.sha1("payload").alias("digest"))
    stats = narrow.agg(F.sum("n").alias("n"), F.count("*").alias("rows")).first()
    shards = max(1, -(-int(stats.n or 0) // shard_bytes), min(8, int(stats.rows) // 200))
    sample = narrow.where("page_id IS NOT NULL").select("page_id").orderBy(F.xxhash64("page_id"), "page_id").limit(SAMPLE)
    ids = np.sort(np.array([r.page_id for r in sample.collect()], np.int64))
    bounds = np.unique(ids[[len(ids) * k // shards for k in range(1, shards)]]) if len(ids) else ids

    @F.pandas_udf("int")
    def shard_of(page: pd.Series) -> pd.Series:
        at = np.searchsorted(bounds, page.fillna(np.iinfo(np.int64).min).to_numpy(np.int64), side="right")
        return pd.Series(at.astype(np.int32))

    # the largest page id of every payload that occurs more than once: few rows, and a hot payload is pre-aggregated
    last = narrow.where((F.col("n") >= dedup_bytes) & F.col("page_id").isNotNull()).groupBy("digest").agg(F.max("page_id").alias("last"), F.count("*").alias("c")) \
        .where("c > 1").select("digest", "last")
    sure = narrow.where((F.col("n") >= dedup_bytes) & F.col("page_id").isNotNull()).join(last, "digest").select("page_id", "digest", "last").distinct()
    # such pages' marks travel with the records, ahead of them: the payloads move once
    marks = sure.select("page_id", F.lit("").alias("url"), F.lit(b"").alias("payload"), "digest", "last", F.lit(0).alias("kind"))
    rows = src.select("page_id", "url", "payload", F.sha1("payload").alias("digest"), F.lit(None).cast("long").alias("last"), F.lit(1).alias("kind")) \
        .union(marks).withColumn("shard", shard_of(F.coalesce("page_id", F.lit(np.iinfo(np.int64).min).cast("long"))))
    ordered = rows.repartitionById(len(bounds) + 1, F.col("shard")).sortWithinPartitions("shard", F.col("page_id").asc_nulls_first(), "kind", "digest", "url")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        attempt = uuid.uuid4().hex
        files, root = _filesystem(path)
        files.create_dir(f"{root}/_temporary", recursive=True)
        out, state = None, {}
        info = _record([("WARC-Type", "warcinfo"), ("WARC-Record-ID", _record_id(None, -1)), ("WARC-Date", DATE),
                        ("Content-Type", "application/warc-fields")], b"format: WARC File Format 1.1\r\n")
        shard, part, copy, before = -1, 0, 0, None
        marked: tuple[int | None, dict[str, int]] = (None, {})  # a page id, and the last page of each payload it shares

        def close() -> dict:
            out.close()
            return {"shard": shard, "part": part, "temp": state["temp"], "n_records": state["records"], "n_bytes": state["bytes"],
                    "sha256": state["sha"].hexdigest()}

        def put(record: bytes) -> None:
            member = gzip.compress(record, 6, mtime=0)
            out.write(member)
            state["bytes"] += len(member)
            state["sha"].update(member)

        for r in core.rows_of(batches):
            if r["kind"] == 0:
                if marked[0] != r["page_id"]:
                    marked = (r["page_id"], {})
                marked[1][r["digest"]] = r["last"]
                continue
            if out is not None and (r["shard"] != shard or state["bytes"] >= file_bytes):
                yield core.batch_of(WRITTEN, [close()])
                part, out = part + 1, None
            if r["shard"] != shard:
                shard, part = r["shard"], 0
            if out is None:
                temp = f"_temporary/{shard:06d}-{part:06d}-{attempt}.warc.gz"
                out = files.open_output_stream(f"{root}/{temp}", compression=None)
                state = {"temp": temp, "records": 0, "bytes": 0, "sha": hashlib.sha256()}
                put(info)
            key = r["page_id"], r["digest"]
            again = key == before  # a repeated row: the first one of the page is the response
            copy = copy + 1 if before is not None and before[0] == r["page_id"] else 0
            before = key
            last = marked[1].get(r["digest"]) if r["page_id"] is not None and marked[0] == r["page_id"] else None
            refers = last if last is not None and (last != r["page_id"] or again) else None
            put(page_record(r["page_id"], r["url"], bytes(r["payload"]), refers, copy))
            state["records"] += 1
        if out is not None:
            yield core.batch_of(WRITTEN, [close()])

    done = [r.asDict() for r in ordered.mapInArrow(write, WRITTEN).collect()]  # one row per file
    files, root = _filesystem(path)
    manifest = []
    for r in sorted(done, key=lambda r: (r["shard"], r["part"])):
        name = f"part-{r['shard']:06d}-{r['part']:06d}.warc.gz"
        files.move(f"{root}/{r['temp']}", f"{root}/{name}")
        manifest.append((name, r["n_records"], r["n_bytes"], r["sha256"]))
    files.create_dir(root, recursive=True)
    with files.open_output_stream(f"{root}/_manifest.tmp") as f:
        f.write("".join(json.dumps(dict(zip(("file", "n_records", "n_bytes", "sha256"), m, strict=True))) + "\n" for m in manifest).encode())
    files.move(f"{root}/_manifest.tmp", f"{root}/manifest.json")
    return spark.createDataFrame(manifest, "file string, n_records long, n_bytes long, sha256 string")


def _members(stream) -> Iterator[bytes]:
    """The gzip members of a stream, one at a time."""
    rest = b""
    while True:
        z, out = zlib.decompressobj(31), []
        while not z.eof:
            data = rest or stream.read(1 << 20)
            rest = b""
            if not data:
                if out:
                    raise EOFError("a record of the archive is cut off")
                return
            out.append(z.decompress(data))
        rest = z.unused_data
        yield b"".join(out)


def parse_record(record: bytes) -> tuple[dict[str, str], bytes]:
    head, block = record.split(b"\r\n\r\n", 1)
    headers = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    block = block[:int(headers["Content-Length"])]
    if headers["WARC-Block-Digest"] != "sha1:" + base64.b32encode(hashlib.sha1(block).digest()).decode():
        raise ValueError(f"the digest of {headers['WARC-Record-ID']} does not fit its block")
    return headers, block


def read_archive(spark: SparkSession, path: str, payloads: bool = False) -> DataFrame:
    """The page records of the files that the manifest names (and the payloads of responses, if asked for)."""
    files, root = _filesystem(path)
    with files.open_input_stream(f"{root}/manifest.json") as f:
        names = [json.loads(x)["file"] for x in f.read().decode().splitlines()]
    schema = OUT + (", payload binary" if payloads else "")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, root = _filesystem(path)
        for b in batches:
            for name in b.column(0).to_pylist():
                rows, held = [], 0
                with files.open_input_stream(f"{root}/{name}", compression=None) as stream:
                    for member in _members(stream):
                        h, block = parse_record(member)
                        if h["WARC-Type"] == "warcinfo":
                            continue
                        http, body = block.split(b"\r\n\r\n", 1)
                        length = next(int(x.split(b":")[1]) for x in http.split(b"\r\n") if x.lower().startswith(b"content-length:"))
                        digest = base64.b32decode(h["WARC-Payload-Digest"].removeprefix("sha1:")).hex()
                        if h["WARC-Type"] == "response" and (len(body) != length or hashlib.sha1(body).hexdigest() != digest):
                            raise ValueError(f"the payload of {h['WARC-Record-ID']} does not fit its digest")
                        refers = h.get("X-Refers-To-Page-Id")
                        rows.append({"page_id": int(h["X-Page-Id"]) if h["X-Page-Id"] else None, "url": h["WARC-Target-URI"],
                                     "payload_bytes": length, "payload_digest": digest, "record_type": h["WARC-Type"],
                                     "refers_to": int(refers) if refers else None} | ({"payload": body} if payloads else {}))
                        held += len(body) if payloads else 200
                        if held > 1 << 22:
                            yield core.batch_of(schema, rows)
                            rows, held = [], 0
                yield core.batch_of(schema, rows)

    n = max(1, len(names))
    return spark.createDataFrame([(x,) for x in names], "file string").repartition(n, "file").mapInArrow(read, schema)

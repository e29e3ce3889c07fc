"""WARC round trip, revisits, determinism."""

import gzip
import hashlib
import json
import os
import random

from pyspark.sql import functions as F

from ebbflow.llm.warc import read_archive, write_archive


def cases():
    r = random.Random(1)
    big = ["<p>" + "é" * r.randint(600, 3000) + str(i) for i in range(5)]
    rows = [(i, f"http://h/{i}?q=ä", r.choice(big) if r.random() < 0.5 else "x" * r.randint(0, 1500) + str(i)) for i in range(150)]
    return rows + [(300, None, None), (301, "u", ""), (302, "u\r\nX: y", "s" * 999), (303, "u", "s" * 999), (304, "u", "s" * 1000), (305, "u", "s" * 1000),
                   (None, "n", big[0]), (None, "n", big[0]), (400, "a", big[1]), (400, "b", big[1]), (400, "c", big[2]), (2**53 + 1, "z", "line\r\n\r\nline")]


def test_round_trip(spark, tmp_dir):
    rows = cases()
    d = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("digest", F.lit(1)).withColumn("shard", F.lit("s"))
    one = write_archive(d.repartition(4), f"{tmp_dir}/a", file_bytes=4000, shard_bytes=50_000)
    write_archive(d.repartition(2), f"file://{tmp_dir}/b", file_bytes=4000, shard_bytes=50_000)
    names = [json.loads(x)["file"] for x in open(f"{tmp_dir}/a/manifest.json")]
    assert len(names) > 5 and one.agg(F.sum("n_records")).first()[0] == len(rows)
    assert sorted(f for f in os.listdir(f"{tmp_dir}/a") if f.endswith(".gz")) == names
    assert all(open(f"{tmp_dir}/a/{x}", "rb").read() == open(f"{tmp_dir}/b/{x}", "rb").read() for x in names)
    assert gzip.open(f"{tmp_dir}/a/{names[0]}").read().startswith(b"WARC/1.1\r\nWARC-Type: warcinfo")
    got = read_archive(spark, f"{tmp_dir}/a", payloads=True).collect()
    assert len(got) == len(rows)
    body = {}
    for i, _, h in rows:
        body.setdefault(i, []).append((h or "").encode())
    last = {}
    for i, _, h in rows:
        if i is not None and len((h or "").encode()) >= 1000:
            last[h] = max(last.get(h, i), i)
    seen = set()
    for r in got:
        p = next(x for x in body[r.page_id] if hashlib.sha1(x).hexdigest() == r.payload_digest)
        assert r.payload_bytes == len(p)
        end = last.get(p.decode()) if r.page_id is not None else None
        if end is None or end == r.page_id and (r.page_id, p) not in seen and r.record_type == "response":
            assert (r.record_type, r.refers_to, bytes(r.payload)) == ("response", None, p)
            seen.add((r.page_id, p))
        else:
            assert (r.record_type, r.refers_to) == ("revisit", end)


def test_empty_table(spark, tmp_dir):
    d = spark.createDataFrame([], "page_id long, url string, html string")
    write_archive(d, f"{tmp_dir}/e")
    assert read_archive(spark, f"{tmp_dir}/e").collect() == []

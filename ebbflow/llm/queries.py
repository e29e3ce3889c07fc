"""The registered queries of the training-data operators, over their whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

Query = Callable[[SparkSession, str], DataFrame]


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ebbflow.llm import toxicity

    docs = _table(spark, sf_dir, "documents")
    model = toxicity.train(docs, _table(spark, sf_dir, "labels"), train_on=~toxicity.held_out(F.col("doc_id"), 5, 0))
    return toxicity.score(docs, model).select(
        "doc_id", toxicity.held_out(F.col("doc_id"), 5, 0).alias("held_out"), "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op2_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ebbflow.llm.warc import read_archive, write_archive
    from ebbflow.session import scratch_path

    path = scratch_path(spark, "warc")
    write_archive(_table(spark, sf_dir, "pages"), path)
    return read_archive(spark, path).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op3_language_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    from ebbflow.llm.attention_lm import score

    return score(_table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), folds=7, fold=2)


def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ebbflow.llm.decontaminate import overlaps

    return overlaps(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"), least=1)


def op5_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    from ebbflow.llm.bpe_trie import encode

    return encode(_table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), digests=True)


def op6_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ebbflow.llm.jaccard_join import near_duplicates

    return near_duplicates(_table(spark, sf_dir, "documents"))


def op7_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ebbflow.llm.ann import search

    return search(_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0, k=20)


def op8_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ebbflow.llm.suffix_dedup import remove_repeated_strings

    return remove_repeated_strings(_table(spark, sf_dir, "documents"), length=50)


def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ebbflow.llm import langid
    from ebbflow.llm.toxicity import held_out

    docs = _table(spark, sf_dir, "documents")
    out = held_out(F.col("doc_id"), 5, 0)
    model = langid.train(docs, train_on=~out)
    return langid.predict(docs, model).select("doc_id", out.alias("held_out"), "lang_pred", "score")


def op10_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ebbflow.llm.window_dedup import remove_repeated_windows

    return remove_repeated_windows(_table(spark, sf_dir, "documents"), width=13)


def op11_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    from ebbflow.llm.alignment import align

    return align(_table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model"))


def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ebbflow.llm.phrases import collocations

    return collocations(_table(spark, sf_dir, "documents"), least=30, top=2000)


def op13_exact_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ebbflow.llm.exact_search import search

    return search(_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0, k=20)


QUERIES: dict[str, Query] = {
    "op1_toxicity": op1_toxicity,
    "op2_warc": op2_warc,
    "op3_language_model": op3_language_model,
    "op4_decontamination": op4_decontamination,
    "op5_bpe": op5_bpe,
    "op6_jaccard_join": op6_jaccard_join,
    "op7_nearest_neighbours": op7_nearest_neighbours,
    "op8_suffix_dedup": op8_suffix_dedup,
    "op9_language_id": op9_language_id,
    "op10_substring_dedup": op10_substring_dedup,
    "op11_alignment": op11_alignment,
    "op12_collocations": op12_collocations,
    "op13_exact_search": op13_exact_search,
}

ORACLE: dict[str, str] = {
    "op2_warc": r"""
WITH p AS (
  SELECT page_id, coalesce(html, '') AS h FROM pages
), g AS (
  SELECT page_id, strlen(h) AS n, sha1(h) AS digest, max(page_id) OVER (PARTITION BY h) AS last FROM p
)
SELECT page_id, CAST(n AS BIGINT) AS payload_bytes, digest AS payload_digest,
       CASE WHEN n >= 1000 AND last <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN n >= 1000 AND last <> page_id THEN last END AS refers_to
FROM g
""",
    "op10_substring_dedup": r"""
WITH words AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents
), starts AS (
  SELECT doc_id, unnest(generate_series(1, len(w) - 12)) AS p, w FROM words WHERE len(w) >= 13
), windows AS (
  SELECT doc_id, p, array_to_string(w[p:p + 12], ' ') AS s FROM starts
), repeated AS (
  SELECT doc_id, p FROM (SELECT doc_id, p, min(doc_id) OVER (PARTITION BY s) AS low FROM windows) WHERE low < doc_id
), gone AS (
  SELECT DISTINCT doc_id, p + k AS p FROM repeated, generate_series(0, 12) AS g(k)
), tokens AS (
  SELECT doc_id, unnest(generate_series(1, len(w))) AS p, unnest(w) AS x FROM words
), kept AS (
  SELECT t.doc_id, count(*) AS n_kept, string_agg(t.x, ' ' ORDER BY t.p) AS kept
  FROM tokens t ANTI JOIN gone g ON t.doc_id = g.doc_id AND t.p = g.p GROUP BY t.doc_id
)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, CAST(len(d.w) - coalesce(k.n_kept, 0) AS BIGINT) AS n_removed,
       sha256(coalesce(k.kept, '')) AS kept_sha256
FROM words d LEFT JOIN kept k USING (doc_id)
""",
    "op12_collocations": r"""
WITH pieces AS (
  SELECT doc_id, lang, unnest(regexp_split_to_array(text, '[.,;:!?\x0A-\x0D]')) AS piece
  FROM (SELECT doc_id, coalesce(lang, 'und') AS lang,
               translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text FROM documents)
), w AS (
  SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces
), grams AS (
  SELECT lang, m, w[p:p + m - 1] AS g
  FROM (SELECT lang, w, m, unnest(generate_series(1, len(w) - m + 1)) AS p FROM w, generate_series(1, 4) AS k(m) WHERE len(w) >= m)
), f AS (
  SELECT lang, g, m, count(*) AS a FROM grams GROUP BY ALL HAVING count(*) >= 30
), totals AS (
  SELECT lang, CAST(sum(len(w)) AS BIGINT) AS n FROM w GROUP BY lang
), cuts AS (
  SELECT c.lang, c.g, c.m, c.a, k, x.a AS l, y.a AS r, CAST(2000000 * CAST(c.a AS HUGEINT) // (x.a + y.a) AS BIGINT) AS score
  FROM (SELECT *, unnest(generate_series(1, m - 1)) AS k FROM f WHERE m >= 2) c
  JOIN f x ON x.lang = c.lang AND x.g = c.g[:k] JOIN f y ON y.lang = c.lang AND y.g = c.g[k + 1:]
), best AS (
  SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, g ORDER BY score, k) = 1
), inner_parts AS (
  SELECT lang, g[p:p + s - 1] AS g, max(a) AS longer
  FROM (SELECT lang, g, a, s, unnest(generate_series(1, m - s + 1)) AS p FROM f, generate_series(2, 3) AS k(s) WHERE m > s) GROUP BY ALL
), kept AS (
  SELECT b.lang, array_to_string(b.g, ' ') AS phrase, b.a, b.l, b.r, b.score
  FROM best b LEFT JOIN inner_parts i ON i.lang = b.lang AND i.g = b.g WHERE i.longer IS NULL OR 100 * CAST(i.longer AS HUGEINT) < 80 * CAST(b.a AS HUGEINT)
)
SELECT lang, rank, phrase, a, l, r, n, score
FROM (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept)
JOIN totals USING (lang) WHERE rank <= 2000
""",
    "op13_exact_search": r"""
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(64 * CAST(x AS DOUBLE))) AS e FROM embeddings
  WHERE vec_id IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.e, c.e) AS BIGINT) AS score
  FROM v q JOIN v c ON c.vec_id <> q.vec_id AND len(c.e) = len(q.e) WHERE q.vec_id % 20 = 0
)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s) WHERE rank <= 20
""",
}

"""The registered queries of this subpackage, and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from . import (
    alignment, bpe, debruijn, gridjoin, kneser, outliers, packing, quality, simhash, suffixdedup,
    toxicity, vafile, whitening,
)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(fn):
        QUERIES[name] = fn
        if sql:
            ORACLES[name] = sql
        return fn

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query("op1_grid_order", """
WITH RECURSIVE v AS (
  SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0
), l AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b
  ON a.vec_id <> b.vec_id AND list_cosine_similarity(a.e, b.e) >= 0.95
), r(v, c) AS (
  SELECT vec_id, vec_id FROM embeddings UNION SELECT l.b, r.c FROM r JOIN l ON l.a = r.v
), c AS (SELECT v, min(c) AS c FROM r GROUP BY v),
n AS (SELECT a, count(*) AS n FROM l GROUP BY a)
SELECT c.v AS vec_id, coalesce(n.n, 0) AS n_links, c.c AS component_id, c.v = c.c AS kept
FROM c LEFT JOIN n ON n.a = c.v""")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gridjoin.link_vectors(table(spark, sf_dir, "embeddings"))


@query("op2_suffix_dedup", r"""
WITH d AS (
  SELECT doc_id, hex(encode(coalesce(text, ''))) AS x FROM documents
), p AS (SELECT doc_id, unnest(generate_series(0, length(x) // 2 - 200)) AS i FROM d
), h AS (SELECT doc_id, i, md5(substr(x, 2 * i + 1, 400)) AS h FROM p JOIN d USING (doc_id)
), r AS (SELECT doc_id, i FROM h QUALIFY count(*) OVER (PARTITION BY h) > 1
), s AS (SELECT doc_id, i, coalesce(i > lag(i) OVER w + 200, true) AS opens FROM r
  WINDOW w AS (PARTITION BY doc_id ORDER BY i)
), n AS (SELECT doc_id, i, sum(opens::INT) OVER (PARTITION BY doc_id ORDER BY i) AS run FROM s
), e AS (SELECT doc_id, run, min(i) AS a, max(i) + 200 AS b FROM n GROUP BY ALL
), c AS (SELECT doc_id, x, run, b, substr(x, 2 * lag(b, 1, 0) OVER w + 1,
    2 * (a - lag(b, 1, 0) OVER w)) AS piece, b - a AS size FROM e JOIN d USING (doc_id)
  WINDOW w AS (PARTITION BY doc_id ORDER BY run)
), k AS (SELECT doc_id, count(*) AS n_spans, sum(size) AS n_removed,
    string_agg(piece, '' ORDER BY run) || substr(any_value(x), 2 * max(b) + 1) AS kept
  FROM c GROUP BY doc_id)
SELECT doc_id, CAST(length(x) // 2 AS BIGINT) AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT)
  AS n_removed, CAST(coalesce(n_spans, 0) AS BIGINT) AS n_spans,
  sha256(unhex(coalesce(kept, x))) AS kept_sha256 FROM d LEFT JOIN k USING (doc_id)""")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffixdedup.remove_repeats(table(spark, sf_dir, "documents")).drop("kept")


@query("op3_kneser_ney")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return kneser.score(table(spark, sf_dir, "documents"))


@query("op4_simhash")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


@query("op5_de_bruijn", r"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents
), p AS (SELECT doc_id, w, unnest(generate_series(1, len(w) - 19)) AS i FROM d
), h AS (SELECT doc_id, i, md5(array_to_string(w[i:i + 19], ' ')) AS h FROM p
), r AS (SELECT doc_id, i, row_number() OVER (PARTITION BY h ORDER BY doc_id, i) > 1 AS later FROM h
), g AS (SELECT DISTINCT doc_id, i + k AS j FROM r, range(20) t(k) WHERE later
), u AS (SELECT doc_id, unnest(w) AS x, generate_subscripts(w, 1) AS j FROM d
), k AS (SELECT doc_id, count(*) AS n, string_agg(x, ' ' ORDER BY j) AS kept
  FROM u ANTI JOIN g USING (doc_id, j) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words,
  CAST(len(w) - coalesce(k.n, 0) AS BIGINT) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM d LEFT JOIN k USING (doc_id)""")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return debruijn.remove_earlier(table(spark, sf_dir, "documents")).drop("kept")


@query("op6_nb_svm")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")) \
        .select("doc_id", "held_out", "score", "predicted")


@query("op7_byte_bpe")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    tokens = bpe.read_ranks(spark, public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
    return bpe.encode(table(spark, sf_dir, "documents"), tokens, public_tokenizers.PATTERN)


@query("op8_va_topk", """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS e
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT q.vec_id AS query_id, c.vec_id AS vec_id,
    CAST(list_sum(list_transform(list_zip(q.e, c.e), lambda p: p[1] * p[2])) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id % 50 = 0 AND c.vec_id <> q.vec_id
), r AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s
)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM r WHERE rank <= 5""")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return vafile.top_k(vectors, vectors.where(F.col("vec_id") % 50 == 0))


@query("op9_best_fit")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_apart(table(spark, sf_dir, "documents"))


@query("op10_toxicity_cnn")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")) \
        .select("doc_id", "held_out", "score", "predicted")


@query("op11_whitening")
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(table(spark, sf_dir, "embeddings"))


@query("op12_alignment")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    # Vocabularies have a fixed size; they travel with the tasks.
    with open(public_tokenizers.path("byte_bpe_50k.json"), "rb") as f, \
            open(public_tokenizers.path("piece_bpe_32k.model"), "rb") as g:
        first, second = f.read(), g.read()
    pattern = public_tokenizers.PATTERN
    return alignment.align(table(spark, sf_dir, "documents"),
                           lambda: alignment.byte_level(first, pattern),
                           lambda: alignment.piece_level(second))


@query("op13_outliers")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return outliers.check(table(spark, sf_dir, "documents")).drop("level")

"""The registered queries of this folder: thin digests over the operators."""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (bpe, collocations, html, jaccard, language, linededup, mixing, parsing, secrets, tokenstore, topk,
               toxicity, whitening)
from .common import held_out, shared_path, table


def _docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents")


def op1_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.scan_secrets(_docs(spark, sf_dir))
    count = lambda k: F.size(F.filter("base", lambda s: s["rank"] == k)).cast("long")
    return found.select("doc_id", count(0).alias("n_assign"), count(1).alias("n_access"),
                        count(2).alias("n_hex"),
                        F.sha2(secrets.spans_text(F.col("base")).cast("binary"), 256).alias("base_sha256"),
                        secrets.spans_text(F.col("spans")).alias("spans"))


def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _docs(spark, sf_dir)
    return (language.predict(docs, language.learn(docs))
            .select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score"))


def op3_html_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = html.extract_pages(table(spark, sf_dir, "pages"))
    return found.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


def op4_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    members, _ = jaccard.near_duplicates(_docs(spark, sf_dir), words=4, percent=85)
    return members.select("doc_id", "n_shingles", "component_id", "n_links")


def tokenizer_path(name: str) -> str:
    """Place of a public tokenizer file; the package is there on every node."""
    import public_tokenizers
    return public_tokenizers.path(name)


def op5_bpe_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = bpe.encode_documents(_docs(spark, sf_dir), tokenizer_path("byte_bpe_50k.json"))
    return done.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"),
                       F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))


def op6_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (mixing.mix_sources(_docs(spark, sf_dir))
            .select("doc_id", "size", "source_size", "target", "taken", "first_slot"))


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _docs(spark, sf_dir)
    scorer = toxicity.learn(docs, table(spark, sf_dir, "labels"))
    return (toxicity.score_texts(docs, scorer)
            .select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
                    (F.col("score") >= 0.5).cast("int").alias("predicted")))


def op8_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = topk.quantise(table(spark, sf_dir, "embeddings"))
    return topk.exact_topk(vectors, vectors.filter("vec_id % 20 = 0"), k=20)


def op9_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parsing.edited_likeness(_docs(spark, sf_dir))


def op10_token_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = tokenstore.write_store(_docs(spark, sf_dir), shared_path(spark, "token-store"),
                                  tokenizer_path("word_bpe_49k.json"), end_id=2)
    return tokenstore.read_all(spark, path)


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = whitening.whiten(table(spark, sf_dir, "embeddings"))
    return done.select("vec_id", "component", F.col("n").cast("long").alias("n"),
                       F.col("deviation").try_cast("long").alias("deviation"),
                       "whitened", "explained", "identity_error")


def op12_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = linededup.dedup_lines(_docs(spark, sf_dir))
    return done.select("doc_id", "n_lines", "n_dropped",
                       F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(_docs(spark, sf_dir)).withColumnRenamed("group", "lang")


QUERIES = {
    "op1_secret_scan": op1_secret_scan,
    "op2_language_id": op2_language_id,
    "op3_html_extract": op3_html_extract,
    "op4_ngram_jaccard": op4_ngram_jaccard,
    "op5_bpe_roundtrip": op5_bpe_roundtrip,
    "op6_source_mix": op6_source_mix,
    "op7_toxicity": op7_toxicity,
    "op8_exact_topk": op8_exact_topk,
    "op9_fingerprint": op9_fingerprint,
    "op10_token_store": op10_token_store,
    "op11_whitening": op11_whitening,
    "op12_line_dedup": op12_line_dedup,
    "op13_collocations": op13_collocations,
}

ORACLE = {
    "op6_source_mix": r"""
WITH d AS (
  SELECT doc_id, source,
         CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size
  FROM documents),
s AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
         1 + (row_number() OVER (ORDER BY encode(source) NULLS LAST) - 1) %% 3 AS weight
  FROM d GROUP BY source),
o AS (
  SELECT *, sum(source_size) OVER () AS total, sum(weight) OVER () AS weights,
         coalesce(sum(3 * source_size) OVER w, 0) AS caps_before,
         coalesce(sum(weight) OVER w, 0) AS weights_before
  FROM s WINDOW w AS (ORDER BY 3.0 * source_size / weight, encode(source) NULLS LAST
                      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
c AS (
  SELECT *, 3 * source_size * (weights - weights_before) < weight * (total - caps_before) AS is_cut FROM o),
f AS (
  SELECT *, sum(CASE WHEN is_cut THEN 3 * source_size ELSE 0 END) OVER () AS cut_cap,
         sum(CASE WHEN is_cut THEN weight ELSE 0 END) OVER () AS cut_w FROM c),
t AS (
  SELECT source, source_size,
         CASE WHEN is_cut THEN CAST(3 * source_size AS DOUBLE)
              ELSE CAST(weight * (total - cut_cap) AS DOUBLE) / greatest(weights - cut_w, 1) END AS target FROM f),
q AS (SELECT *, CAST(least(floor(target + 0.5), 3 * source_size) AS BIGINT) AS quota FROM t),
b AS (
  SELECT source, n, CAST(sum(n) OVER (ORDER BY encode(source) NULLS LAST) AS BIGINT) AS upto,
         CAST(sum(n) OVER () AS BIGINT) AS slots
  FROM (SELECT source, CAST(ceil(quota / 1024) AS BIGINT) AS n FROM q) WHERE n > 0),
x AS (
  SELECT slot, y - floor(y) AS x FROM (
    SELECT slot, (u - floor(u)) + (v - floor(v)) AS y FROM (
      SELECT slot, (slot // 1048576) * CAST('%r' AS DOUBLE) AS u, (slot %% 1048576) * CAST('%r' AS DOUBLE) AS v
      FROM (SELECT unnest(range((SELECT coalesce(max(slots), 0) FROM b))) AS slot)))),
r AS (
  SELECT b.source, slot, row_number() OVER (PARTITION BY b.source ORDER BY slot) - 1 AS block
  FROM x JOIN b ON x.x >= (upto - n) / slots AND x.x < upto / slots),
l AS (
  SELECT d.doc_id, d.size, q.source, q.source_size, q.target, q.quota,
         coalesce(sum(d.size) OVER (PARTITION BY d.source
           ORDER BY md5('0|' || coalesce(CAST(d.doc_id AS VARCHAR), '') || '|' || d.size), d.size, d.doc_id
           ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS start
  FROM d JOIN q ON d.source IS NOT DISTINCT FROM q.source)
SELECT doc_id, size, source_size, target,
       CAST(greatest(0, least(start + size, quota) - start)
          + greatest(0, least(start + size + source_size, quota) - (start + source_size))
          + greatest(0, least(start + size + 2 * source_size, quota) - (start + 2 * source_size)) AS BIGINT) AS taken,
       CAST(CASE WHEN size > 0 AND start < quota
                 THEN coalesce(r.slot, (SELECT max(slots) FROM b) + start // 1024) END AS BIGINT) AS first_slot
FROM l LEFT JOIN r ON r.source IS NOT DISTINCT FROM l.source AND r.block = l.start // 1024
""" % (mixing.GOLDEN * (1 << 20) % 1.0, mixing.GOLDEN),
    "op8_exact_topk": r"""
WITH v AS (
  SELECT vec_id, [CAST(floor(64 * CAST(x AS DOUBLE)) AS DOUBLE) for x in embedding] AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len([x for x in embedding if x IS NULL OR NOT isfinite(x)]) = 0),
s AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_dot_product(q.v, c.v) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id % 20 = 0 AND q.vec_id <> c.vec_id),
r AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 20
""",
    "op12_line_dedup": r"""
WITH d AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents),
l AS (SELECT doc_id, unnest(ls) AS line, generate_subscripts(ls, 1) AS pos FROM d),
k AS (
  SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l),
f AS (SELECT key, min(doc_id) AS first FROM k WHERE length(key) >= 10 GROUP BY key HAVING count(DISTINCT doc_id) >= 2),
m AS (SELECT k.*, coalesce(f.first <> k.doc_id, false) AS gone FROM k LEFT JOIN f ON k.key = f.key)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM m GROUP BY doc_id
""",
    "op13_collocations": r"""
WITH p AS (
  SELECT coalesce(lang, 'und') AS lang,
         unnest(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                                             'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents),
w AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS ws FROM p),
t AS (SELECT lang, CAST(sum(len(ws)) AS BIGINT) AS n FROM w GROUP BY lang),
g AS (
  SELECT lang, size, phrase, count(*) AS f FROM (
    SELECT lang, 1 AS size, unnest(ws) AS phrase FROM w
    UNION ALL
    SELECT lang, 2, unnest([ws[i] || ' ' || ws[i + 1] for i in range(1, len(ws))]) FROM w
    UNION ALL
    SELECT lang, 3, unnest([ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2] for i in range(1, len(ws) - 1)]) FROM w) u
  GROUP BY ALL),
c AS (SELECT *, string_split(phrase, ' ') AS ws FROM g WHERE size >= 2 AND f >= 10),
s AS (
  SELECT c.lang, c.phrase, c.size, c.f AS a, k.k, l.f AS l, r.f AS r,
         1000000::HUGEINT * c.f * c.f // (l.f::HUGEINT * r.f) AS score
  FROM c JOIN (VALUES (1), (2)) k(k) ON k.k < c.size
  JOIN g l ON l.lang = c.lang AND l.phrase = array_to_string(c.ws[1:k.k], ' ')
  JOIN g r ON r.lang = c.lang AND r.phrase = array_to_string(c.ws[k.k + 1:], ' ')),
b AS (SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
i AS (
  SELECT lang, phrase, max(f) AS f FROM (
    SELECT lang, ws[1] || ' ' || ws[2] AS phrase, f FROM c WHERE size = 3
    UNION ALL SELECT lang, ws[2] || ' ' || ws[3], f FROM c WHERE size = 3) x GROUP BY ALL),
o AS (SELECT b.* FROM b LEFT JOIN i ON i.lang = b.lang AND i.phrase = b.phrase AND b.size = 2
      WHERE i.f IS NULL OR 100 * i.f < 50 * b.a)
SELECT o.lang, row_number() OVER (PARTITION BY o.lang ORDER BY score DESC, a DESC, encode(phrase)) AS rank,
       phrase, a, l, r, n, CAST(score AS BIGINT) AS score
FROM o JOIN t ON t.lang = o.lang QUALIFY rank <= 2000
""",
}

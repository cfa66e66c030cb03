"""The registered query of each operator: production parameters, whole tables."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gradeline.llm import (
    bpe,
    jaccard,
    lines,
    neighbours,
    packing,
    pii,
    quality,
    ranking,
    repeats,
    secrets,
    spelling,
    tiling,
    toxicity,
)
from gradeline.llm.common import documents

VOCABULARY = "byte_bpe_50k.tiktoken"
VOCABULARY_JSON = "byte_bpe_50k.json"
END_ID = 2


def _listed(kinds: Column, starts: Column, ends: Column, only: tuple[str, ...] | None = None) -> Column:
    """``kind:start:end`` of the spans, joined by commas."""
    spans = F.arrays_zip(kinds.alias("k"), starts.alias("s"), ends.alias("e"))
    if only:
        spans = F.filter(spans, lambda x: x["k"].isin(*only))
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x["k"], x["s"], x["e"])), ",")


def _is(kind: str) -> Callable[[Column], Column]:
    return lambda x: x == kind


def _digests(df: DataFrame, base: tuple[str, ...]) -> list[Column]:
    kinds, starts, ends = F.col("kinds"), F.col("starts"), F.col("ends")
    counts = [F.size(F.filter("kinds", _is(kind))).cast("long").alias(f"n_{kind}") for kind in base]
    digest = F.sha2(_listed(kinds, starts, ends, base), 256).alias("base_sha256")
    return [*counts, digest, _listed(kinds, starts, ends).alias("spans")]


def op1_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    found = secrets.find_secrets(docs, keep=["doc_id"], words=secrets.word_ranks(docs))
    return found.select("doc_id", *_digests(found, ("assign", "access", "hex")))


def op2_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = repeats.remove_repeats(documents(spark, sf_dir), keep=["doc_id"])
    return kept.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


def op3_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = jaccard.similar_documents(documents(spark, sf_dir))
    return found.select(F.col("id").alias("doc_id"), "class_id", "n_links")


def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    benchmark = documents(spark, sf_dir, "benchmark")
    found = tiling.decontaminate(documents(spark, sf_dir), benchmark, keep=["doc_id"])
    return found.select("doc_id", F.col("item").cast("long").alias("item_id"), "coverage", "contaminated")


def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = lines.remove_repeated_lines(documents(spark, sf_dir))
    return kept.select("doc_id", "n_lines", "n_removed", F.sha2("text", 256).alias("kept_sha256"))


def op6_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.nearest(documents(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


def op7_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path(VOCABULARY)
    return bpe_digests(bpe.encode_texts(documents(spark, sf_dir), path, public_tokenizers.PATTERN, keep=["doc_id"], decode=True))


def bpe_digests(decoded: DataFrame) -> DataFrame:
    return decoded.select(
        "doc_id",
        "n_tokens",
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = documents(spark, sf_dir), documents(spark, sf_dir, "labels")
    held_out = F.crc32(F.col("doc_id").cast("string")) % 4 == 2
    model = toxicity.fit_toxicity(docs, labels, allowed=~held_out)
    scored = toxicity.score_toxicity(docs, model, keep=["doc_id"])
    return scored.select(
        "doc_id",
        F.coalesce(held_out, F.lit(False)).alias("held_out"),
        "score",
        F.col("toxic").cast("int").alias("predicted"),
    )


def op9_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    found = pii.find_personal(docs, pii.fit_spans(docs), keep=["doc_id"])
    return found.select("doc_id", *_digests(found, pii.BASE_KINDS))


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    return quality.score_quality(docs, quality.fit_quality(docs), keep=["doc_id"])


def op11_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.cut_documents(
        documents(spark, sf_dir),
        public_tokenizers.path(VOCABULARY_JSON),
        public_tokenizers.path(VOCABULARY),
        public_tokenizers.PATTERN,
        END_ID,
    )
    return packing.pack(pieces.select("doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32")))


def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.spelling_variants(documents(spark, sf_dir))


def op13_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = ranking.rank_documents(documents(spark, sf_dir), documents(spark, sf_dir, "benchmark"))
    return found.select(F.col("item").alias("item_id"), "rank", F.col("id").alias("doc_id"), "score")


REGISTER: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_secret_scan": op1_secret_scan,
    "op2_substring_dedup": op2_substring_dedup,
    "op3_jaccard_join": op3_jaccard_join,
    "op4_decontamination": op4_decontamination,
    "op5_line_dedup": op5_line_dedup,
    "op6_nearest": op6_nearest,
    "op7_byte_bpe": op7_byte_bpe,
    "op8_toxicity": op8_toxicity,
    "op9_personal_data": op9_personal_data,
    "op10_quality": op10_quality,
    "op11_best_fit_packing": op11_best_fit_packing,
    "op12_spelling_variants": op12_spelling_variants,
    "op13_lexical_search": op13_lexical_search,
}

# In the statements a window is 35 words, as in repeats.LEAST_WORDS, and 20 neighbours are kept.
ORACLES = {
    "op2_substring_dedup": r"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w
  FROM documents),
v AS (
  SELECT r, s, md5(array_to_string(w[s : s + 34], ' ')) AS h
  FROM (SELECT r, w, unnest(range(1, len(w) - 33)) AS s FROM d WHERE len(w) >= 35)),
again AS (SELECT h FROM v GROUP BY h HAVING count(*) > 1),
g AS (SELECT DISTINCT r, s + unnest(range(0, 35)) AS i FROM v SEMI JOIN again USING (h)),
k AS (
  SELECT r, string_agg(word, ' ' ORDER BY i) AS kept, count(*) AS n_kept
  FROM (SELECT r, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS i FROM d) ANTI JOIN g USING (r, i)
  GROUP BY r)
SELECT doc_id, len(w) AS n_words, len(w) - coalesce(n_kept, 0) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM d LEFT JOIN k USING (r)""",
    "op6_nearest": """
WITH e AS (
  SELECT DISTINCT vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0
    AND len([x FOR x IN embedding IF x <> 0]) > 0),
p AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.v, c.v) AS score
  FROM e q JOIN e c ON len(q.v) = len(c.v) AND q.vec_id <> c.vec_id WHERE q.vec_id % 20 = 0)
SELECT query_id, CAST(row_number() OVER o AS INTEGER) AS rank, vec_id, score
FROM p WINDOW o AS (PARTITION BY query_id ORDER BY score DESC, vec_id)
QUALIFY row_number() OVER o <= 20""",
    # crc32 byte by byte from its table of 256 remainders; near words share a word without one letter.
    "op12_spelling_variants": r"""
WITH RECURSIVE bits AS (
  SELECT range AS i, 0 AS step, range AS v FROM range(256)
  UNION ALL SELECT i, step + 1, CASE WHEN v % 2 = 1 THEN xor(v // 2, 3988292384) ELSE v // 2 END FROM bits WHERE step < 8),
remainders AS (SELECT list(v ORDER BY i) AS t FROM bits WHERE step = 8),
runs AS (
  SELECT doc_id, run, count(*) AS n FROM (
    SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[A-Za-z\x{C0}-\x{FF}]+')) AS run
    FROM documents) WHERE length(run) >= 5 GROUP BY ALL),
hashed AS (
  SELECT run, n, xor(4294967295, list_reduce(
    list_prepend(4294967295, list_transform(string_split(regexp_replace(hex(encode(concat(doc_id, ':', run))), '(..)', '\1 ', 'g')[:-2], ' '),
      lambda b: CAST('0x' || b AS BIGINT))),
    lambda c, b: xor(c // 256, t[xor(c % 256, b) + 1]))) AS h
  FROM runs, remainders),
cut AS (
  SELECT CASE WHEN h % 97 = 0 THEN run[1 : h % length(run)] || run[h % length(run) + 2 :] ELSE run END AS word, n FROM hashed),
words AS (SELECT word, CAST(sum(n) AS BIGINT) AS n FROM cut WHERE length(word) >= 5 GROUP BY word HAVING sum(n) >= 3),
shorter AS (SELECT word, i, word[1 : i - 1] || word[i + 1 :] AS rest FROM (SELECT word, unnest(range(1, length(word) + 1)) AS i FROM words)),
near AS (
  SELECT a.word AS a, b.word AS b FROM shorter a JOIN shorter b USING (rest, i) WHERE a.word <> b.word
  UNION SELECT s.word, w.word FROM shorter s JOIN words w ON s.rest = w.word
  UNION SELECT w.word, s.word FROM shorter s JOIN words w ON s.rest = w.word),
best AS (
  SELECT a AS word, count(*) AS n_near, first(b ORDER BY n DESC, encode(b)) AS top, max(n) AS top_n
  FROM near JOIN words ON b = word GROUP BY a),
forms AS (
  SELECT word, n, coalesce(n_near, 0) AS n_near, CASE WHEN top_n >= 2 * n THEN top END AS form, CASE WHEN top_n >= 2 * n THEN top_n END AS form_n
  FROM words LEFT JOIN best USING (word)),
paths AS (
  SELECT word, word AS place FROM forms
  UNION ALL SELECT paths.word, forms.form FROM paths JOIN forms ON place = forms.word WHERE form IS NOT NULL)
SELECT f.word, f.form, place AS root, f.n, f.n_near, f.form_n
FROM paths JOIN forms f ON paths.word = f.word JOIN forms last ON place = last.word WHERE last.form IS NULL""".replace("\\", "\\"),
    "op13_lexical_search": r"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS w
  FROM documents),
totals AS (SELECT CAST(count(*) AS BIGINT) AS nd, CAST(sum(len(w)) AS BIGINT) AS nt FROM d WHERE len(w) > 0),
tf AS (SELECT r, term, count(*) AS tf FROM (SELECT r, unnest(w) AS term FROM d) GROUP BY ALL),
weights AS (SELECT term, CAST(floor(1000 * ln((2 * any_value(nd) + 2) / (2 * count(*) + 1))) AS BIGINT) AS wt FROM tf, totals GROUP BY term),
q AS (
  SELECT item_id, term, count(*) AS qtf FROM (
    SELECT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
    FROM (SELECT DISTINCT item_id, text FROM benchmark)) GROUP BY ALL),
s AS (
  SELECT item_id, r, doc_id, CAST(sum(qtf * wt * ((1000000000 * tf) // (1000 * tf + 12 * (75 + (25 * len(w) * nd) // nt)))) AS BIGINT) AS score
  FROM q JOIN weights USING (term) JOIN tf USING (term) JOIN d USING (r), totals GROUP BY ALL)
SELECT item_id, CAST(row_number() OVER o AS INTEGER) AS rank, doc_id, score
FROM s WHERE score > 0 WINDOW o AS (PARTITION BY item_id ORDER BY score DESC, doc_id)
QUALIFY row_number() OVER o <= 20""",
}

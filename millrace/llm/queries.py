"""The registered queries of the operators, and SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm import chat_format, decontamination, divergence, exact_dedup, hard_negatives, html_text, jaccard_join, language_id, language_model, line_dedup, packing, substring_dedup, toxicity

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(f):
    QUERIES[f.__name__] = f
    return f


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query
def op5_exact_dedup(spark, sf_dir):
    """Which document of each group of equal texts stays."""
    return exact_dedup.exact_duplicates(table(spark, sf_dir, "documents"))


SQL["op5_exact_dedup"] = r"""
WITH d AS (
  SELECT doc_id, length(coalesce(text, '')) AS chars,
         sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', '', 'g')) AS text_sha256
  FROM documents),
r AS (
  SELECT *, row_number() OVER w AS place, count(*) OVER (PARTITION BY text_sha256) AS group_size,
         first_value(doc_id) OVER w AS keep_id
  FROM d WINDOW w AS (PARTITION BY text_sha256 ORDER BY chars DESC, doc_id))
SELECT doc_id, keep_id, group_size, place = 1 AS kept, text_sha256 FROM r
"""


@query
def op8_jaccard_join(spark, sf_dir):
    """Groups of documents whose 5-word shingle sets have a Jaccard similarity of 0.75 or more."""
    return jaccard_join.near_duplicate_components(table(spark, sf_dir, "documents")).drop("kept")


@query
def op9_language_id(spark, sf_dir):
    """The language of every document, learned from two thirds of them."""
    docs = table(spark, sf_dir, "documents")
    held_out = language_id.in_fold("doc_id", 3, 1)
    found = language_id.identify(docs.select("doc_id", "text"), language_id.fit(docs.filter(~held_out)))
    return found.select("row.doc_id", "lang_pred", "score").withColumn("held_out", held_out)


@query
def op1_packing(spark, sf_dir):
    """All documents in sequences of at most 4096 tokens."""
    pieces = packing.tokenized_pieces(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))
    return packing.pack(pieces)


@query
def op10_decontamination(spark, sf_dir):
    """Documents that hold passages of the benchmark, with the best overlap of each item."""
    found = decontamination.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.drop("text_key")


@query
def op7_html_extraction(spark, sf_dir):
    """The main text of every page."""
    return html_text.extract(table(spark, sf_dir, "pages"))


@query
def op2_chat_formatting(spark, sf_dir):
    """All conversations as training texts, read back from them."""
    control = "</s>[INST] ok [/INST]"
    one = spark.range(1).select(F.lit(-7).cast("long").alias("conv_id"), F.to_json(F.struct(F.lit(control).alias("prompt"), F.lit(control).alias("completion"))).alias("record"))
    turns = chat_format.turns_of_table(table(spark, sf_dir, "conversations")).unionByName(chat_format.turns_of_records(one)[0])
    back = chat_format.parsed(chat_format.formatted(turns))
    said = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    loss = F.array_join("learned", "")
    return back.select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(said, 256).alias("turns_sha256"),
        F.length(loss).cast("long").alias("loss_chars"), F.sha2(loss, 256).alias("loss_sha256"), F.length("formatted").cast("long").alias("formatted_chars"),
    )


@query
def op4_toxicity(spark, sf_dir):
    """How likely each document is toxic, learned from three quarters of the labels."""
    docs = table(spark, sf_dir, "documents")
    held_out = language_id.in_fold("doc_id", 4, 2)
    index = toxicity.fit(docs, table(spark, sf_dir, "labels").filter(~held_out))
    out = toxicity.score(docs, index).drop("evidence").withColumn("held_out", held_out)
    return out.withColumn("predicted", (F.col("score") >= toxicity.THRESHOLD).cast("int"))


@query
def op3_lm_scoring(spark, sf_dir):
    """The log10 probability of every document, learned from six sevenths of them."""
    return language_model.scored(table(spark, sf_dir, "documents"), language_id.in_fold("doc_id", 7, 2))


@query
def op6_line_dedup(spark, sf_dir):
    """Which lines of each document go because an equal or similar line stays elsewhere."""
    return line_dedup.documents_lines(line_dedup.line_decisions(table(spark, sf_dir, "documents"))).drop("text_key")


@query
def op11_substring_dedup(spark, sf_dir):
    """How many words of each document go because 50 words in a row stand in an earlier document too."""
    return substring_dedup.remove_repeats(table(spark, sf_dir, "documents")).select("doc_id", "n_words", "n_removed", "kept_sha256")


SQL["op11_substring_dedup"] = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents),
win AS (
  SELECT doc_id, p, md5(array_to_string(ws[p:p + 49], ' ')) AS h
  FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 48)) AS p FROM d WHERE len(ws) >= 50)),
low AS (SELECT h, min(doc_id) AS first_id FROM win GROUP BY h),
gone AS (
  SELECT DISTINCT doc_id, unnest(range(p, p + 50)) AS q
  FROM win JOIN low USING (h) WHERE first_id < doc_id),
gone_lists AS (SELECT doc_id, list(q) AS qs FROM gone GROUP BY doc_id)
SELECT doc_id, len(ws) AS n_words, coalesce(len(qs), 0) AS n_removed,
       sha256(array_to_string(CASE WHEN qs IS NULL THEN ws ELSE list_filter(ws, lambda w, i: NOT list_contains(qs, i)) END, ' ')) AS kept_sha256
FROM d LEFT JOIN gone_lists USING (doc_id)
"""


@query
def op12_source_divergence(spark, sf_dir):
    """How far the sources of each language are apart, and the terms by which each differs from its language."""
    return divergence.divergences(table(spark, sf_dir, "documents"))


SQL["op12_source_divergence"] = r"""
WITH d AS (
  SELECT row_number() OVER () AS id, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
         translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text
  FROM documents),
w AS (SELECT id, lang, source, unnest(regexp_extract_all(text, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM d),
kept AS (SELECT lang, term, count(*) AS n FROM w GROUP BY lang, term HAVING count(DISTINCT id) >= 3),
l AS (SELECT lang, count(*)::HUGEINT AS v, sum(n)::HUGEINT AS total FROM kept GROUP BY lang),
g AS (SELECT DISTINCT lang, source FROM d),
c AS (SELECT lang, source, term, count(*) AS n FROM w JOIN kept USING (lang, term) GROUP BY lang, source, term),
gt AS (SELECT lang, source, sum(n)::HUGEINT AS total FROM c GROUP BY lang, source),
p AS (
  SELECT g.lang, g.source, kept.term, coalesce(c.n, 0) AS n,
         1 + (1000000000::HUGEINT * (coalesce(c.n, 0) + 1)) // (coalesce(gt.total, 0) + l.v) AS p,
         1 + (1000000000::HUGEINT * (kept.n + 1)) // (l.total + l.v) AS q
  FROM g JOIN kept USING (lang) JOIN l USING (lang)
  LEFT JOIN gt ON gt.lang = g.lang AND gt.source = g.source
  LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = kept.term),
pairs AS (
  SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // b.p) AS value
  FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source
  GROUP BY a.lang, a.source, b.source),
u AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(value, 0) AS value
  FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN pairs ON pairs.lang = a.lang AND pairs.source = a.source AND pairs.item = b.source
  UNION ALL
  SELECT lang, source, 'term', term, (p - q) * (p - q) // q FROM p WHERE n > 0 AND p > q),
r AS (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS place FROM u)
SELECT lang, source, part, item, value::BIGINT AS value, place::INT AS rank FROM r WHERE part = 'pair' OR place <= 200
"""


@query
def op13_hard_negatives(spark, sf_dir):
    """Rows of other labels that score just below the positives of each anchor; every seventh label is moved on by one."""
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.hard_negatives(table(spark, sf_dir, "embeddings").withColumn("label", moved))


SQL["op13_hard_negatives"] = """
WITH e AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS same, list_inner_product(a.v, b.v)::BIGINT AS score
  FROM e a JOIN e b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id),
pos AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5),
hit AS (
  SELECT pos.*, s.vec_id AS negative_id, s.score AS negative_score,
         row_number() OVER (PARTITION BY pos.anchor_id, positive_id ORDER BY s.score DESC, s.vec_id) AS place
  FROM pos JOIN s ON s.anchor_id = pos.anchor_id AND NOT same
   AND 30 * positive_score <= 100 * s.score AND 100 * s.score <= 90 * positive_score)
SELECT anchor_id, positive_id, place::INT AS rank, negative_id, positive_score, negative_score FROM hit WHERE place <= 10
"""

"""The dealt operators as queries over the corpus tables, with DuckDB SQL where SQL can express them."""

from __future__ import annotations

from pyspark.sql import functions as F

from . import bpe, conversation_repair, decontaminate, exact_dedup, language_id, licenses, lm, merge_replay, pii, quality, simhash, text_tries, token_counts
from . import common as C

#: The public tokenizer that the pipeline and the query encode with; its file is read where it is installed.
TOKENIZER = "word_bpe_49k.json"


def tokenizer_path(name: str = TOKENIZER) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_licenses(spark, sf_dir):
    """License phrases, and blocks that meet a license template, in all documents."""
    found = licenses.license_scan(C.table(spark, sf_dir, "documents"))
    starts, base = F.col("places.start"), F.array_distinct("places.label")
    best = F.array_max("blocks.containment")
    return found.select(
        "doc_id", "n_words", F.size("places").cast("long").alias("n_base"), F.array_min(starts).alias("first_word"), F.array_max(starts).alias("last_word"),
        F.array_join(F.array_sort(base), ",").alias("base_labels"), F.array_join(F.array_sort(F.array_union(base, F.col("blocks.label"))), ",").alias("labels"),
        F.when(F.size("places") > 0, 1.0).otherwise(F.coalesce(best, F.lit(0.0))).alias("score"),
    )


def op2_pii(spark, sf_dir):
    """Personal data in all documents: base patterns, and what bootstrapped contexts add."""
    found = pii.find_pii(C.table(spark, sf_dir, "documents"))
    count = lambda kind: F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    return found.select("doc_id", *(count(k) for k in pii.KINDS), F.sha2(pii.as_text(F.col("base")), 256).alias("base_sha256"), pii.as_text(F.col("found")).alias("spans"))


def op3_quality(spark, sf_dir):
    """Quality scores of all documents, by a network that learns from the labels of four fifths of the ids."""
    docs = C.table(spark, sf_dir, "documents")
    return quality.score_quality(docs, quality.fit_quality(docs, C.table(spark, sf_dir, "labels")))


def op4_token_counts(spark, sf_dir):
    """Greedy longest-match token counts of all documents, with the pieces of the public sentencepiece model."""
    begin, go_on = token_counts.sentencepiece_vocabulary(tokenizer_path("piece_bpe_32k.model"))
    return token_counts.token_counts(C.table(spark, sf_dir, "documents"), begin, go_on)


def op5_lm_score(spark, sf_dir):
    """log10 probabilities of all documents under the maximum-entropy model and under add-one counts."""
    return lm.score_texts(C.table(spark, sf_dir, "documents"))


def op6_simhash(spark, sf_dir):
    """SimHash groups of all documents: three-word shingles, three bits."""
    return simhash.simhash_groups(C.table(spark, sf_dir, "documents"), shingle=3, distance=3)


def op7_bpe(spark, sf_dir):
    """Token ids of all documents and their decoded texts, as digests."""
    return bpe.encode_and_decode(C.table(spark, sf_dir, "documents"), tokenizer_path(), with_ids=False, with_text=False)


def op8_decontaminate(spark, sf_dir):
    """Benchmark windows of ten words in all documents."""
    found = decontaminate.contamination(C.table(spark, sf_dir, "documents"), C.table(spark, sf_dir, "benchmark"), window=10)
    n_hit = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
    return found.select(
        "doc_id", "n_words", n_hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (F.size("spans") > 0).alias("contaminated"),
    )


def op9_language_id(spark, sf_dir):
    """Languages of all documents by cross-parsing against labelled text."""
    return language_id.identify_languages(C.table(spark, sf_dir, "documents"))


def op10_exact_dedup(spark, sf_dir):
    """Groups of equal texts over all documents; the largest id of a group stays."""
    return exact_dedup.exact_dedup(C.table(spark, sf_dir, "documents"))


def op11_filter_audit(spark, sf_dir):
    """Five filters over all documents in every order, by language."""
    return text_tries.filter_audit(C.table(spark, sf_dir, "documents"), C.table(spark, sf_dir, "labels"))


def op12_byte_bpe(spark, sf_dir):
    """Byte-level token ids of all documents and their decoded bytes, as digests."""
    import public_tokenizers

    docs = C.table(spark, sf_dir, "documents")
    return merge_replay.encode_and_decode(docs, tokenizer_path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN, with_ids=False, with_text=False)


def op13_conversation_repair(spark, sf_dir):
    """Cheapest repairs of all conversations after damage."""
    conversations = C.table(spark, sf_dir, "conversations")
    rows = conversation_repair.damaged(conversations)
    return conversation_repair.repair(rows, all_ids=conversations, keep_rows=False, count_col="n").summary


QUERIES = {
    f.__name__: f
    for f in (
        op1_licenses, op2_pii, op3_quality, op4_token_counts, op5_lm_score, op6_simhash, op7_bpe, op8_decontaminate, op9_language_id, op10_exact_dedup,
        op11_filter_audit, op12_byte_bpe, op13_conversation_repair,
    )
}

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORDS = rf"regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

ORACLE = {
    "op8_decontaminate": rf"""
WITH d AS (SELECT doc_id, {_WORDS} AS w FROM documents),
b AS (SELECT item_id, {_WORDS} AS w FROM benchmark),
win AS (
  SELECT DISTINCT item_id, list_slice(w, i, least(i + 9, len(w))) AS words
  FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i FROM b WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT len(words) AS size FROM win),
places AS (
  SELECT doc_id, size, i, list_slice(w, i, i + size - 1) AS words
  FROM (SELECT doc_id, w, size, unnest(range(1, len(w) - size + 2)) AS i FROM d, sizes WHERE len(w) >= size)),
occ AS (SELECT DISTINCT doc_id, size, i, item_id FROM places JOIN win USING (words)),
hit AS (SELECT doc_id, count(DISTINCT word) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + size)) AS word FROM occ) GROUP BY doc_id),
items AS (
  SELECT doc_id, count(*) AS n_items, string_agg(name, ',' ORDER BY name) AS names
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS name FROM occ) GROUP BY doc_id)
SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(names, '')) AS items_sha256, n_hit IS NOT NULL AS contaminated
FROM d LEFT JOIN hit USING (doc_id) LEFT JOIN items USING (doc_id)""",
    "op10_exact_dedup": """
SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
       doc_id = max(doc_id) OVER same AS kept, sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW same AS (PARTITION BY coalesce(text, ''))""",
    "op11_filter_audit": r"""
WITH d AS (
  SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w,
         min(doc_id) OVER (PARTITION BY coalesce(text, '')) AS least
  FROM documents),
marks AS (SELECT doc_id, bool_or(quality = 1) AS good, bool_or(toxic = 1) AS toxic FROM labels GROUP BY doc_id),
f AS (
  SELECT part, coalesce(good, false) AS good, coalesce(toxic, false) AS toxic,
         CASE WHEN len(w) < 100 THEN 'A' ELSE '' END || CASE WHEN 100 * len(list_distinct(w)) < 80 * len(w) THEN 'B' ELSE '' END
         || CASE WHEN 100 * (length(t) - length(regexp_replace(t, '[A-Z]', '', 'g'))) > 10 * length(t) THEN 'C' ELSE '' END
         || CASE WHEN regexp_matches(t, '[#$%&*|]') THEN 'D' ELSE '' END || CASE WHEN doc_id > least THEN 'E' ELSE '' END AS fails
  FROM d LEFT JOIN marks USING (doc_id)),
c AS (SELECT part, fails, good, toxic, count(*) AS n FROM f GROUP BY ALL),
letters AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x),
orders AS (
  SELECT a.x || b.x || c.x || d.x || e.x AS o
  FROM letters a JOIN letters b ON b.x <> a.x JOIN letters c ON c.x NOT IN (a.x, b.x)
  JOIN letters d ON d.x NOT IN (a.x, b.x, c.x) JOIN letters e ON e.x NOT IN (a.x, b.x, c.x, d.x)),
steps AS (SELECT o, step, o[step] AS f, o[1:step - 1] AS before FROM orders, unnest([1, 2, 3, 4, 5]) AS u(step)),
r AS (
  SELECT part, o, step, f, fails, good, toxic, n, contains(fails, f) AS here, translate(fails, before, '') <> fails AS earlier
  FROM c, steps),
q AS (
  SELECT part, o AS filter_order, CAST(step AS INTEGER) AS step, f,
         CAST(coalesce(sum(n) FILTER (NOT here AND NOT earlier), 0) AS BIGINT) AS kept,
         CAST(coalesce(sum(n) FILTER (here AND NOT earlier), 0) AS BIGINT) AS removed,
         CAST(coalesce(sum(n) FILTER (here AND earlier), 0) AS BIGINT) AS redundant,
         CAST(coalesce(sum(n) FILTER (fails = f), 0) AS BIGINT) AS unique_fails,
         CAST(coalesce(sum(n) FILTER (here AND NOT earlier AND good), 0) AS BIGINT) AS good_lost,
         CAST(coalesce(sum(n) FILTER (here AND NOT earlier AND toxic), 0) AS BIGINT) AS toxic_lost
  FROM r GROUP BY part, o, step, f)
SELECT part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
       CAST(sum(removed) OVER (PARTITION BY part, f) AS BIGINT) AS shapley
FROM q""",
}

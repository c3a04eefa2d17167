"""The corpus pipeline: quality classifier, exact dedup, near dedup, decontamination, token ids.

Each stage is (name, function); a function takes (spark, docs, sf_dir) and
returns a DataFrame, which is written as Parquet and reread as the next
stage's docs.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from tracelens.llm import bpe, decontaminate, exact_dedup, quality, simhash
from tracelens.llm.common import table
from tracelens.llm.queries import tokenizer_path
from tracelens.session import stage_table


def good(spark, docs, sf_dir):
    """Documents that the quality classifier rejects go."""
    return quality.keep_good(docs, quality.fit_quality(docs, table(spark, sf_dir, "labels")))


def exact(spark, docs, sf_dir):
    """Of equal texts, the document with the largest id stays."""
    return exact_dedup.drop_copies(docs)


def near(spark, docs, sf_dir):
    """Of each group of documents linked at three bits or fewer, the one with the smallest id stays."""
    return simhash.drop_near_copies(docs, shingle=3, distance=3)


def clean(spark, docs, sf_dir):
    """Every run of benchmark windows is cut out of the texts; n_chars is that of the text that stays."""
    cut = decontaminate.remove_contamination(docs, table(spark, sf_dir, "benchmark"), window=10)
    return cut.withColumn("n_chars", F.coalesce(F.char_length("text").cast("long"), F.col("n_chars")))


def token_ids(spark, docs, sf_dir):
    """Token ids of what is left, with digests of the ids and of the text they decode to."""
    return bpe.encode_and_decode(docs, tokenizer_path(), carry=("lang", "source"), with_text=False)


STAGES = [("quality classifier", good), ("exact dedup", exact), ("simhash near-dedup", near), ("benchmark decontamination", clean), ("BPE encoding and decoding", token_ids)]

#: SQL can't express the classifier, the fingerprints and the token ids; tests hold run() against brute force.
ORACLE_SQL = None


def run(spark, sf_dir):
    """All stages over the documents, each written and reread."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stage_table(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)

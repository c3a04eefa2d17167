"""Registered queries: file sources/sinks round trips and model training (S1, K1, M*)."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from ..operators import chunks as C
from ..operators import histogram as H
from ..operators import ml as ML
from ..operators.sampling import DEFAULT_FOLDS
from ..session import scratch_path
from ..sources import readers as R
from . import adapters as A
from .oracle import GRID, chunk_sql
from .registry import register

TEXT_TRACE = """
lines AS (
  SELECT printf('s%d', user_id % 10) AS sample, event_id AS seq,
         CASE WHEN event_type = 'signup' THEN '# ' || props
              ELSE printf('0x%016x: %s 0x%016x  %d  0x%x',
                          event_id + {ins},
                          CASE WHEN event_type IN ('view', 'error') THEN 'R' ELSE 'W' END,
                          CAST(round(value * 100) AS BIGINT) + {tgt},
                          1 << CAST(user_id % 5 AS INTEGER), user_id) END AS value
  FROM events),
trace AS (
  SELECT sample, seq,
         regexp_extract(value, '^(\\w+): (W|R) (\\w+) +(\\d) +(\\w+)', 2) AS rw,
         CAST(regexp_extract(value, '^(\\w+): (W|R) (\\w+) +(\\d) +(\\w+)', 3) AS BIGINT) AS tgt
  FROM lines WHERE NOT starts_with(value, '#')
    AND regexp_extract(value, '^(\\w+): (W|R) (\\w+) +(\\d) +(\\w+)', 2) <> '')""".format(
    ins=A.TEXT_INS_BASE, tgt=A.TEXT_TGT_BASE
)


@register("read_trace_files", chunk_sql(TEXT_TRACE, "seq", A.EVENTS_CHUNKS) + f"""
SELECT sample, access, chunk_size, mode, chunk_id, round(delta, 6) AS delta FROM d WHERE mode IN {GRID}""")
def read_trace_files(spark, sf_dir):
    """Tracer text files -> line order -> parse -> chunk deltas.

    The text files are written once from ``events`` into the shared scratch
    folder; the query then reads them like real uploads.
    """
    root = scratch_path(spark, f"trace-text-{uuid.uuid4().hex[:8]}")
    glob = A.write_events_trace_files(spark, sf_dir, root)
    # Single scan of the text: lines ordered by (split start, row in split),
    # one rank bucket per split.
    tr = R.read_trace(spark, glob, dense_seq=False)
    d = C.chunk_deltas(
        tr, A.TRACE_KEYS, A.EVENTS_CHUNKS, order_cols=("split_start", "split_row"), bucket_rows=1
    )
    return d.select(
        "sample", "access", F.col("chunk_size").cast("long").alias("chunk_size"), "mode",
        F.col("chunk_id").cast("long").alias("chunk_id"), F.round(F.col("delta").cast("double"), 6).alias("delta"),
    )


def _cv(classifier: str, normalizer: str | None):
    def q(spark, sf_dir):
        vec = ML.labelled_vectors(A.embedding_vectors(spark, sf_dir))
        m = ML.cross_validate(vec, classifier, normalizer, k=10, seed=11)
        return m.select(
            F.lit(classifier).alias("classifier"), F.lit(normalizer or "None").alias("normaliser"),
            *[F.round(c, 6).alias(c) for c in ML.METRIC_NAMES],
        )

    q.__doc__ = f"10-fold cross-validation of {classifier} ({normalizer or 'raw'}) on embedding vectors (M1-M9)."
    return q


for _clf in ML.CLASSIFIERS:
    for _norm in ML.NORMALIZERS:
        register(f"cv_{_clf}_{_norm or 'raw'}")(_cv(_clf, _norm))


@register("train_ensemble")
def train_ensemble(spark, sf_dir):
    """(dt, std), (rf, raw), (svm, std) trained on one half, majority vote
    scored over 10 folds of the held-out half (M11, M12)."""
    vec = ML.labelled_vectors(A.embedding_vectors(spark, sf_dir))
    m = ML.train_ensemble(vec, seed=5)
    return m.select(*[F.round(c, 6).alias(c) for c in ML.METRIC_NAMES])


@register("evaluate_feature_grid")
def evaluate_feature_grid(spark, sf_dir):
    """End to end: supplier traces -> chunk deltas -> dense histogram vectors
    -> labelled samples -> cross-validated grid of every feature of every chunk
    size with every classifier, raw and scaled (M1-M10), over the default folds."""
    g = ML.evaluate_grid(_labelled_features(spark, sf_dir), k=DEFAULT_FOLDS, seed=13)
    return g.select("feature", "classifier", "normaliser", *[F.round(c, 6).alias(c) for c in ML.METRIC_NAMES])


def _labelled_features(spark, sf_dir, sizes=A.LINEITEM_CHUNKS):
    tr = A.lineitem_trace(spark, sf_dir)
    d = C.chunk_deltas(tr, A.TRACE_KEYS, sizes, order_cols=A.LINEITEM_ORDER)
    fv = H.feature_vectors(d, A.TRACE_KEYS, A.LINEITEM_RANGES).select(*A.TRACE_KEYS, "feature", "feature_data")
    return fv.join(A.supplier_labels(spark, sf_dir), "sample")


@register("train_ensemble_histogram")
def train_ensemble_histogram(spark, sf_dir):
    """The voting ensemble on one histogram feature of the supplier traces, a vote per run."""
    rows = _labelled_features(spark, sf_dir, (min(A.LINEITEM_CHUNKS),))  # the size of its one feature
    vec = ML.labelled_vectors(rows, ENSEMBLE_FEATURE, extra=("uuid", "run_id"))
    return ML.train_ensemble(vec, seed=5, run_cols=("uuid", "run_id")).select(*[F.round(c, 6).alias(c) for c in ML.METRIC_NAMES])


#: The reference's ensemble feature at the stand-in traces' smallest chunk size, which all of them fill.
ENSEMBLE_FEATURE = ML.ENSEMBLE_FEATURE.replace("5000", str(min(A.LINEITEM_CHUNKS)))

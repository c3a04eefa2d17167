"""Plan-shape guards: the trace is scanned twice (one pruned counting scan)
and shuffled as whole rows exactly once."""

import re

from tracelens.plans.registry import QUERIES

from .conftest import SF_CHECK


def _final_plan(df):
    qe = df._jdf.queryExecution()
    df.collect()
    s = qe.executedPlan().toString()
    return s.split("== Initial Plan ==")[0]


def test_chunk_pipeline_shuffles_trace_once(spark):
    plan = _final_plan(QUERIES["chunk_deltas_all_modes"](spark, SF_CHECK))
    assert len(re.findall(r"FileScan parquet", plan)) == 2
    assert len(re.findall(r"Exchange hashpartitioning\(_k#\d+, _b#\d+L?, \d+\), REPARTITION_BY_COL", plan)) == 1
    # The row-level window (ordered by seq) is partitioned by trace AND bucket,
    # never by the trace alone.
    assert re.search(r"windowspecdefinition\(_k#\d+, _b#\d+L?, seq#\d+L? ASC", plan)
    assert not re.search(r"windowspecdefinition\(_k#\d+, seq#", plan)


def test_feature_vectors_single_trace_pass(spark):
    plan = _final_plan(QUERIES["feature_vectors"](spark, SF_CHECK))
    assert len(re.findall(r"FileScan parquet", plan)) == 2

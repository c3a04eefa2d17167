"""Trace parsing and chunk deltas: the reference's fixtures, computed exactly."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tracelens.functions import trace as TF
from tracelens.operators import chunks as C
from tracelens.sources.readers import parse_trace, read_trace

# The reference's fixture trace (comment header + 9 accesses).
FIXTURE = """#
# Memory Access Trace Generated By Pin
#
0x00007ffd37cd1493: W 0x000000361957ec40  1                0x1
0x00007ffd37cd1497: R 0x0000003619691060  8       0x3619690000
0x00007ffd37cd14a0: R 0x0000003619690090  8                  0
0x00007ffd37cd14ac: R 0x000000007ffe0384  1                  0
0x00007ffd37cd14b5: R 0x000000361957ec40  1                0x1
0x00007ffd37cd14bf: R 0x000000361957ec80  8      0x190c9617040
0x00007ffd37cd14c8: R 0x000000361957ec50  8                  0
0x00007ffd38cd14c8: R 0x000000361957ec50  8                  0
0x00007ffd37cd1493: W 0x000000361957ec40  1                0x1
"""
KEYS = ["sample", "uuid", "run_id"]


def _trace_from_lines(spark, lines, sample="s"):
    rows = [(sample, "u", 0, i, ln) for i, ln in enumerate(lines) if not ln.startswith("#")]
    df = spark.createDataFrame(rows, "sample string, uuid string, run_id int, seq long, value string")
    return parse_trace(df, keep=KEYS + ["seq"])


def _deltas(spark, trace, mode, chunk=C.DEFAULT_CHUNK_SIZE, access="RW", **kw):
    d = C.chunk_delta(trace, KEYS, mode=mode, chunk_size=chunk, access=access, **kw)
    return [float(r["delta"]) for r in d.orderBy("chunk_id").collect()]


def test_fixture_parses_nine_rows(spark):
    tr = _trace_from_lines(spark, FIXTURE.split("\n"))
    assert tr.count() == 9


@pytest.mark.parametrize(
    "mode,expected",
    [
        ("SUM_ABS_REF", 230203830252),
        ("SUM_REF_ASC", -230203830252),
        ("MAX_REF", 1123360),
        ("MIN_REF", -230206073020),
        ("MEAN", -25578203361.333333),
    ],
)
def test_fixture_deltas_one_chunk(spark, mode, expected):
    tr = _trace_from_lines(spark, FIXTURE.split("\n"))
    got = _deltas(spark, tr, mode)
    assert len(got) == 1
    assert got[0] == pytest.approx(expected, abs=1e-6)


def test_more_than_one_chunk(spark):
    pair = ["0x00007ffd37cd1493: W 0x000000361957ec40  1                0x1",
            "0x00007ffd37cd1493: W 0x000000361957ec41  1                0x1"]
    lines = pair * 20000
    tr = _trace_from_lines(spark, lines)
    assert tr.count() == 40000
    assert _deltas(spark, tr, "SUM_ABS_REF", 10000) == [5000.0] * 4


def test_more_than_one_chunk_many_buckets(spark):
    pair = ["0x1: W 0x000000361957ec40  1  0x1", "0x1: W 0x000000361957ec41  1  0x1"]
    tr = _trace_from_lines(spark, pair * 20000)
    # Tiny buckets force the two-level rank across many buckets.
    assert _deltas(spark, tr, "SUM_ABS_REF", 10000, bucket_rows=997) == [5000.0] * 4


def test_read_write_segregation(spark):
    lines = ["0x00007ffd37cd1493: W 0x000000361957ec40  1                0x1",
             "0x00007ffd37cd1493: R 0x000000361957ec41  1                0x1"]
    tr = _trace_from_lines(spark, lines)
    for access, n in (("r", 1), ("w", 1), ("rw", 2)):
        assert tr.where(TF.access_filter(F.col("rw"), access)).count() == n


def test_two_digit_size_dropped(spark):
    lines = ["0x1: R 0x10  16  0x0", "0x2: R 0x20  8  0x0", "0x3: W 0x30  32  0x0"]
    assert _trace_from_lines(spark, lines).count() == 1


def test_kernel_half_address_exact(spark):
    df = spark.createDataFrame([("0xffff800000000000",), ("ffff800000000000",)], "h string")
    vals = [r[0] for r in df.select(TF.hex_to_int(F.col("h"))).collect()]
    assert [int(v) for v in vals] == [18446603336221196288] * 2
    words = df.select(TF.word_to_unsigned(TF.hex_to_word(F.col("h")))).collect()
    assert int(words[0][0]) == 18446603336221196288


def test_unsigned_sums_exact_for_kernel_addresses(spark):
    # 5000 kernel-half targets: sums exceed 2^64; deltas stay exact.
    base = 0xFFFF800000000000
    lines = [f"0x1: W 0x{base + 8 * i:016x}  8  0x0" for i in range(5000)]
    tr = _trace_from_lines(spark, lines)
    got = _deltas(spark, tr, "SUM_REF_ASC", 5000)
    assert got == [float(sum(8 * i for i in range(5000)))]
    assert _deltas(spark, tr, "MAX_REF", 5000) == [8.0 * 4999]


def test_non_hex_raises_or_drops(spark):
    rows = [("s", "u", 0, 0, "0x1: R zz  8  0x0")]
    df = spark.createDataFrame(rows, "sample string, uuid string, run_id int, seq long, value string")
    assert parse_trace(df, keep=["seq"], on_error="drop").count() == 0
    with pytest.raises(Exception):
        parse_trace(df, keep=["seq"], on_error="raise").collect()


def test_trailing_partial_chunk_and_gates(spark):
    n = 10
    lines = [f"0x1: R 0x{100 + i:x}  8  0x0" for i in range(2 * n + 1)]
    tr = _trace_from_lines(spark, lines)
    d = C.chunk_delta(tr, KEYS, mode="MAX_REF", chunk_size=n, access="R")
    rows = d.orderBy("chunk_id").collect()
    assert len(rows) == 3 and float(rows[-1]["delta"]) == 0.0
    # Short trace: no feature at all under the row gate.
    short = _trace_from_lines(spark, lines[: n - 1])
    assert C.chunk_deltas(short, KEYS, [n], ["MAX_REF"], ["R"]).count() == 0
    # Two chunks: deltas exist but the min-chunks gate removes the feature.
    two = _trace_from_lines(spark, lines[: 2 * n])
    d2 = C.chunk_deltas(two, KEYS, [n], ["MAX_REF"], ["R"])
    assert d2.count() == 2 and C.min_chunks_gate(d2, KEYS).count() == 0


def test_min_le_zero_le_max_and_partition(spark):
    rng = np.random.default_rng(7)
    rows = []
    for s in range(3):
        for i in range(int(rng.integers(300, 900))):
            rows.append((f"s{s}", "u", 0, int(i * 3 + s), "R" if rng.random() < 0.4 else "W", int(rng.integers(0, 1 << 40))))
    tr = spark.createDataFrame(rows, "sample string, uuid string, run_id int, seq long, rw string, tgt long")
    d = C.chunk_deltas(tr, KEYS, [16, 32, 64], C.ALL_MODES, bucket_rows=50)
    mins = d.where("mode = 'MIN_REF'").agg(F.max("delta")).first()[0]
    maxs = d.where("mode = 'MAX_REF'").agg(F.min("delta")).first()[0]
    assert mins <= 0 <= maxs
    # Chunks partition the rows: counts per (trace, access, size) add up.
    st = C.chunk_stats(tr, KEYS, [16, 32, 64], bucket_rows=50)
    chk = st.groupBy("sample", "access", "chunk_size").agg(F.sum("cnt").alias("c"), F.first("n_rows").alias("n"))
    assert chk.where("c != n").count() == 0
    # Same deltas with one bucket and with many buckets, with and without roll-up.
    d1 = C.chunk_deltas(tr, KEYS, [16, 32, 64], C.ALL_MODES, bucket_rows=1 << 30)
    assert d.exceptAll(d1).count() == 0 and d1.exceptAll(d).count() == 0
    d3 = C.chunk_deltas(tr, KEYS, [17, 32], C.ALL_MODES, bucket_rows=64)
    d4 = C.chunk_deltas(tr, KEYS, [17], C.ALL_MODES).unionByName(C.chunk_deltas(tr, KEYS, [32], C.ALL_MODES))
    assert d3.exceptAll(d4).count() == 0 and d4.exceptAll(d3).count() == 0


def test_read_trace_files_line_order(spark, tmp_dir):
    import os

    d = os.path.join(tmp_dir, "abc", "u1", "2")
    os.makedirs(d)
    body = FIXTURE
    with open(os.path.join(d, "trace.out"), "w") as fh:
        fh.write(body)
    import gzip

    d2 = os.path.join(tmp_dir, "def", "u1", "0")
    os.makedirs(d2)
    with gzip.open(os.path.join(d2, "trace.out.gz"), "wt") as fh:
        fh.write(body)
    tr = read_trace(spark, f"{tmp_dir}/*/*/*/*")
    assert tr.count() == 18
    got = {r["sample"]: r["run_id"] for r in tr.select("sample", "run_id").distinct().collect()}
    assert got == {"abc": 2, "def": 0}
    first = tr.where("sample = 'def'").orderBy("seq").first()
    # seq is the line number in the file: the three comment lines leave a gap.
    assert first["rw"] == "W" and first["seq"] == 3
    v = C.chunk_delta(tr, KEYS, mode="SUM_ABS_REF").collect()
    assert sorted(float(r["delta"]) for r in v) == [230203830252.0] * 2


def test_single_scan_line_order_matches_dense(spark, tmp_dir):
    import os

    for s in ("a1", "b2"):
        d = os.path.join(tmp_dir, s, "u", "0")
        os.makedirs(d)
        with open(os.path.join(d, "t.out"), "w") as fh:
            fh.write(FIXTURE * 50)
    # Small splits: several splits per file, several files per partition.
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        dense = read_trace(spark, f"{tmp_dir}/*/*/*/*")
        one = read_trace(spark, f"{tmp_dir}/*/*/*/*", dense_seq=False)
        a = C.chunk_deltas(dense, KEYS, [7, 21], C.ALL_MODES)
        b = C.chunk_deltas(one, KEYS, [7, 21], C.ALL_MODES, order_cols=("split_start", "split_row"), bucket_rows=1)
        assert a.count() > 0
        assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def test_ingest_traces_round_trip(spark, tmp_dir):
    import os

    from tracelens.sources.sinks import ingest_traces

    d = os.path.join(tmp_dir, "in", "abc", "u1", "0")
    os.makedirs(d)
    with open(os.path.join(d, "trace.out"), "w") as fh:
        fh.write(FIXTURE * 3)
    out = os.path.join(tmp_dir, "table")
    ingest_traces(spark, f"{tmp_dir}/in/*/*/*/*", out)
    t = spark.read.parquet(out)
    assert t.count() == 27 and set(t.columns) >= {"sample", "uuid", "run_id", "seq", "rw", "tgt"}
    assert [float(r["delta"]) for r in C.chunk_delta(t, KEYS, mode="SUM_ABS_REF", chunk_size=9).collect()] == [230203830252.0] * 3


def test_adaptive_buckets_same_result(spark):
    # Order values with a huge spread: fixed buckets would be one per row or one for all.
    rows = [("s", "u", 0, int(i) * 10**9 + (i % 7), "R" if i % 3 else "W", i * 37 % 1000) for i in range(3000)]
    rows += [("t", "u", 0, i, "W", i) for i in range(500)]
    tr = spark.createDataFrame(rows, "sample string, uuid string, run_id int, seq long, rw string, tgt long")
    a = C.chunk_deltas(tr, KEYS, [10, 30], C.ALL_MODES, bucket_rows=1 << 62)
    b = C.chunk_deltas(tr, KEYS, [10, 30], C.ALL_MODES, bucket_rows=97, adaptive_buckets=True)
    assert a.count() > 0 and a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0

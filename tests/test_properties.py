"""Property test: chunk deltas equal a brute-force Python definition on random
traces with full-range unsigned 64-bit targets (kernel half included)."""

from fractions import Fraction

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from tracelens.operators import chunks as C

KEYS = ["sample", "uuid", "run_id"]
TWO_64 = 1 << 64


def _signed(u: int) -> int:
    return u - TWO_64 if u >= 1 << 63 else u


def brute_force(traces, sizes, modes):
    """Reference definition: filter by access, slice by position, deltas from the first target."""
    out = {}
    for name, rows in traces.items():
        for access in ("R", "W", "RW"):
            tg = [t for _, rw, t in sorted(rows) if rw in access]
            for n in sizes:
                if len(tg) < n:
                    continue  # row gate
                for c in range(0, (len(tg) + n - 1) // n):
                    chunk = tg[c * n:(c + 1) * n]
                    first = chunk[0]
                    d = [t - first for t in chunk]
                    for m in modes:
                        if len(chunk) == 1:
                            v = Fraction(0)
                        elif m == "SUM_ABS_REF":
                            v = Fraction(abs(sum(d)))
                        elif m == "SUM_REF_ASC":
                            v = Fraction(sum(d))
                        elif m == "MAX_REF":
                            v = Fraction(max(d))
                        elif m == "MIN_REF":
                            v = Fraction(min(d))
                        else:
                            v = Fraction(sum(d), len(d))
                        out[(name, access, n, m, c)] = v
    return out


addr = st.one_of(
    st.integers(0, (1 << 47) - 1),
    st.integers((1 << 64) - (1 << 47), (1 << 64) - 1),
    st.integers(0, (1 << 64) - 1),
)
trace = st.lists(st.tuples(st.sampled_from("RW"), addr), min_size=1, max_size=60)


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    traces=st.lists(trace, min_size=1, max_size=4),
    sizes=st.lists(st.integers(1, 12), min_size=1, max_size=3, unique=True),
    bucket_rows=st.sampled_from([1, 3, 7, 1 << 20]),
)
def test_chunk_deltas_match_brute_force(spark, traces, sizes, bucket_rows):
    data = {}
    rows = []
    for i, tr in enumerate(traces):
        name = f"s{i}"
        # Sparse, shuffled sequence numbers: order comes from seq, not from input order.
        seqs = [3 * j + (i % 3) for j in range(len(tr))]
        data[name] = [(s, rw, t) for s, (rw, t) in zip(seqs, tr)]
        rows += [(name, "u", 0, s, rw, _signed(t)) for s, rw, t in reversed(data[name])]
    df = spark.createDataFrame(rows, "sample string, uuid string, run_id int, seq long, rw string, tgt long")
    got = {
        (r["sample"], r["access"], r["chunk_size"], r["mode"], r["chunk_id"]): (int(r["delta_num"]), int(r["delta_den"]))
        for r in C.chunk_deltas(df, KEYS, sizes, C.ALL_MODES, bucket_rows=bucket_rows).collect()
    }
    want = brute_force(data, sizes, C.ALL_MODES)
    assert set(got) == set(want)
    for k, v in want.items():
        num, den = got[k]
        assert Fraction(num, den) == v, k

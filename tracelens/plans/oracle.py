"""DuckDB SQL twins of the registered queries (plain window/aggregate SQL).

The adapters of ``plans.adapters`` are repeated here textually, so DuckDB sees
the same stand-in input.  These are the brute-force definitions: one window
per trace, no buckets, no roll-up.
"""

from __future__ import annotations

from . import adapters as A

from .registry import ORACLE

EVENTS_TRACE = """
trace AS (
  SELECT printf('s%d', user_id % 10) AS sample, event_id AS seq,
         CASE WHEN event_type IN ('view', 'error') THEN 'R' ELSE 'W' END AS rw,
         CAST(round(value * 100) AS BIGINT) AS tgt
  FROM events)"""

LINEITEM_TRACE = """
trace AS (
  SELECT printf('p%d', l_suppkey) AS sample,
         l_orderkey, l_linenumber, l_partkey, l_quantity, l_extendedprice,
         l_discount, l_tax, l_returnflag, l_linestatus, l_shipdate,
         CASE WHEN l_returnflag = 'N' THEN 'R' ELSE 'W' END AS rw,
         CAST(round(l_extendedprice * 100) AS BIGINT) AS tgt
  FROM lineitem)"""


def _list(xs) -> str:
    return "[" + ", ".join(str(int(x)) for x in xs) + "]"


def chunk_sql(trace_cte: str, order: str, sizes, accesses=("R", "W", "RW"), gate: bool = True) -> str:
    """CTEs ``pos`` .. ``deltas(sample, access, chunk_size, mode, chunk_id, num, den, delta)``."""
    acc = ", ".join(f"'{a}'" for a in accesses)
    return f"""WITH {trace_cte},
views AS (
  SELECT sample, rw AS access, {order}, tgt FROM trace
  UNION ALL
  SELECT sample, 'RW' AS access, {order}, tgt FROM trace),
pos AS (
  SELECT sample, access, tgt,
         row_number() OVER (PARTITION BY sample, access ORDER BY {order}) AS pos,
         count(*) OVER (PARTITION BY sample, access) AS n_rows
  FROM views WHERE access IN ({acc})),
sizes AS (SELECT CAST(unnest({_list(sizes)}) AS BIGINT) AS chunk_size),
ch AS (
  SELECT p.sample, p.access, s.chunk_size, (p.pos - 1) // s.chunk_size AS chunk_id,
         count(*) AS cnt, CAST(sum(p.tgt) AS HUGEINT) AS s, min(p.tgt) AS mn, max(p.tgt) AS mx,
         arg_min(p.tgt, p.pos) AS first, max(p.n_rows) AS n_rows
  FROM pos p CROSS JOIN sizes s
  GROUP BY 1, 2, 3, 4),
gated AS (SELECT * FROM ch WHERE {'n_rows >= chunk_size' if gate else 'TRUE'}),
deltas AS (
  SELECT sample, access, chunk_size, chunk_id, 'SUM_ABS_REF' AS mode, abs(s - cnt * first) AS num, CAST(1 AS BIGINT) AS den FROM gated
  UNION ALL SELECT sample, access, chunk_size, chunk_id, 'SUM_REF_ASC', s - cnt * first, 1 FROM gated
  UNION ALL SELECT sample, access, chunk_size, chunk_id, 'MAX_REF', CAST(mx - first AS HUGEINT), 1 FROM gated
  UNION ALL SELECT sample, access, chunk_size, chunk_id, 'MIN_REF', CAST(mn - first AS HUGEINT), 1 FROM gated
  UNION ALL SELECT sample, access, chunk_size, chunk_id, 'MEAN', s - cnt * first, cnt FROM gated),
d AS (SELECT *, CAST(num AS DOUBLE) / den AS delta FROM deltas)"""


EVENTS_ORDER = "seq"
LINEITEM_ORDER = ", ".join(A.LINEITEM_ORDER)
GRID = "('SUM_REF_ASC', 'MAX_REF', 'MIN_REF', 'MEAN')"


def _ranges_cte(ranges) -> str:
    rows = ", ".join(
        f"(CAST({int(n)} AS BIGINT), CAST({int(lo)} AS BIGINT), CAST({int(hi)} AS BIGINT))"
        for n, (lo, hi) in sorted(ranges.items())
    )
    return f"rng(chunk_size, lo, hi) AS (VALUES {rows})"


ORACLE["trace_parse"] = r"""
WITH lines AS (
  SELECT printf('s%d', user_id % 10) AS sample, event_id AS seq,
         CASE WHEN event_type = 'signup' THEN '# ' || props
              ELSE printf('0x%016x: %s 0x%016x  %d  0x%x',
                          event_id + {TEXT_INS_BASE},
                          CASE WHEN event_type IN ('view', 'error') THEN 'R' ELSE 'W' END,
                          CAST(round(value * 100) AS BIGINT) + {TEXT_TGT_BASE},
                          1 << CAST(user_id % 5 AS INTEGER), user_id) END AS value
  FROM events),
m AS (
  SELECT sample, seq,
         regexp_extract(value, '^(\w+): (W|R) (\w+) +(\d) +(\w+)', 1) AS ins_hex,
         regexp_extract(value, '^(\w+): (W|R) (\w+) +(\d) +(\w+)', 2) AS rw,
         regexp_extract(value, '^(\w+): (W|R) (\w+) +(\d) +(\w+)', 3) AS tgt_hex
  FROM lines WHERE NOT starts_with(value, '#'))
SELECT sample, seq, CAST(ins_hex AS BIGINT) AS ins, rw, CAST(tgt_hex AS BIGINT) AS tgt
FROM m WHERE rw <> ''
""".replace("{TEXT_INS_BASE}", str(A.TEXT_INS_BASE)).replace("{TEXT_TGT_BASE}", str(A.TEXT_TGT_BASE))

ORACLE["access_filter_counts"] = f"""
WITH {EVENTS_TRACE.strip()}
SELECT sample, count(*) FILTER (WHERE rw = 'R') AS n_r, count(*) FILTER (WHERE rw = 'W') AS n_w,
       count(*) FILTER (WHERE rw IN ('R', 'W')) AS n_rw
FROM trace GROUP BY sample
"""

ORACLE["chunk_deltas_all_modes"] = chunk_sql(EVENTS_TRACE, EVENTS_ORDER, A.EVENTS_CHUNKS) + f"""
SELECT sample, access, chunk_size, mode, chunk_id, round(delta, 6) AS delta FROM d WHERE mode IN {GRID}
"""

for _mode in ("SUM_ABS_REF", "SUM_REF_ASC", "MAX_REF", "MIN_REF", "MEAN"):
    ORACLE[f"chunk_delta_{_mode.lower()}"] = chunk_sql(EVENTS_TRACE, EVENTS_ORDER, [100], ["RW"], gate=False) + f"""
SELECT sample, access, chunk_size, mode, chunk_id, round(delta, 6) AS delta FROM d WHERE mode = '{_mode}'
"""

ORACLE["chunk_deltas_lineitem"] = chunk_sql(LINEITEM_TRACE, LINEITEM_ORDER, A.LINEITEM_CHUNKS) + f"""
SELECT sample, access, chunk_size, mode, chunk_id, round(delta, 6) AS delta FROM d WHERE mode IN {GRID}
"""

ORACLE["raw_deltas"] = chunk_sql(EVENTS_TRACE, EVENTS_ORDER, A.EVENTS_CHUNKS) + f"""
SELECT sample, printf('%s-MemOffsetMode.%s-%d', access, mode, chunk_size) AS feature, chunk_id,
       round(delta, 6) AS delta
FROM d WHERE mode IN {GRID}
"""

def hist_sql(trace_cte: str, order: str, sizes, ranges) -> str:
    """CTEs up to ``hist`` (sparse bins) and ``meta`` (metadata) over the grid modes."""
    return chunk_sql(trace_cte, order, sizes) + f""",
{_ranges_cte(ranges)},
feat AS (
  SELECT sample, access, chunk_size, mode FROM d WHERE mode IN {GRID}
  GROUP BY ALL HAVING count(*) >= 3),
gd AS (SELECT d.* FROM d JOIN feat USING (sample, access, chunk_size, mode)),
binned AS (
  SELECT gd.*, rng.lo, rng.hi,
         (num >= CAST(lo AS HUGEINT) * den AND num <= CAST(hi AS HUGEINT) * den) AS in_range,
         CASE WHEN num >= CAST(lo AS HUGEINT) * den AND num <= CAST(hi AS HUGEINT) * den
              THEN least(((num - CAST(lo AS HUGEINT) * den) * 1024) // (CAST(hi - lo AS HUGEINT) * den), 1023)
         END AS bin
  FROM gd JOIN rng USING (chunk_size)),
hist AS (
  SELECT sample, access, chunk_size, mode, CAST(bin AS BIGINT) AS bin, count(*) AS n
  FROM binned WHERE in_range GROUP BY ALL),
meta AS (
  SELECT sample, access, chunk_size, mode,
         CAST(trunc(min(delta)) AS BIGINT) AS histogram_min,
         CAST(trunc(max(delta)) AS BIGINT) AS histogram_max,
         CAST(trunc(avg(delta)) AS BIGINT) AS histogram_mean,
         CAST(trunc(stddev_samp(delta)) AS BIGINT) AS histogram_std_dev
  FROM gd GROUP BY ALL)"""


_HIST_BASE = hist_sql(EVENTS_TRACE, EVENTS_ORDER, A.EVENTS_CHUNKS, A.EVENTS_RANGES)

ORACLE["delta_histogram"] = _HIST_BASE + """
SELECT sample, access, chunk_size, mode, bin, n FROM hist
"""

ORACLE["histogram_metadata"] = _HIST_BASE + """
SELECT * FROM meta
"""

ORACLE["feature_vectors"] = _HIST_BASE + """,
dense AS (
  SELECT f.sample, f.access, f.chunk_size, f.mode,
         string_agg(CAST(coalesce(h.n, 0) AS VARCHAR), ',' ORDER BY r.i) AS feature_data,
         CAST(sum(coalesce(h.n, 0)) AS BIGINT) AS n_binned
  FROM feat f CROSS JOIN range(0, 1024) r(i)
  LEFT JOIN hist h ON h.sample = f.sample AND h.access = f.access AND h.chunk_size = f.chunk_size
                  AND h.mode = f.mode AND h.bin = r.i
  GROUP BY ALL)
SELECT m.sample, printf('%s-MemOffsetMode.%s-%d', m.access, m.mode, m.chunk_size) AS feature,
       dense.feature_data, dense.n_binned,
       m.histogram_min, m.histogram_max, m.histogram_mean, m.histogram_std_dev
FROM meta m JOIN dense USING (sample, access, chunk_size, mode)
"""

ORACLE["range_monitor"] = chunk_sql(EVENTS_TRACE, EVENTS_ORDER, A.EVENTS_CHUNKS) + f""",
{_ranges_cte(A.EVENTS_RANGES)}
SELECT chunk_size, round(min(delta), 6) AS observed_min, round(max(delta), 6) AS observed_max,
       min(lo) AS range_lo, max(hi) AS range_hi, count(*) AS n_deltas,
       CAST(sum(CASE WHEN num >= CAST(lo AS HUGEINT) * den AND num <= CAST(hi AS HUGEINT) * den THEN 0 ELSE 1 END) AS BIGINT) AS n_out_of_range
FROM d JOIN rng USING (chunk_size)
WHERE mode IN {GRID}
GROUP BY chunk_size
"""

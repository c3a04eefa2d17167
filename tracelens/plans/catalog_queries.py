"""Registered queries: labelling, sampling, quality, joins, metrics, uploads, liveness.

Stand-ins (see ``plans.adapters``): samples = customers, uploads and scan
verdicts = orders, feature documents = lineitem counts per order, binaries =
documents, label/prediction pairs = labels (+ documents for scores),
heartbeats and runs = events.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import catalog as CF
from ..operators import joins as J
from ..operators import labelling as L
from ..operators import metrics as M
from ..operators import quality as Q
from ..operators import sampling as U
from ..operators.rank import ordered_positions
from . import adapters as A
from .registry import register


def _r6(c):
    return F.round(c.cast("double"), 6)


# -- shared SQL text (the adapters, spelled for DuckDB) -----------------------

SAMPLES = """samples AS (
  SELECT c.c_custkey AS sample, n.n_name AS source,
         CASE WHEN c.c_mktsegment = 'MACHINERY' THEN 'malware'
              WHEN c.c_mktsegment = 'HOUSEHOLD' THEN 'benign' END AS label
  FROM customer c LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey)"""
SCANS = """scans AS (
  SELECT o_custkey AS sample,
         CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 'vti' ELSE 'existing' END AS report,
         printf('e%d', o_orderkey) AS engine, o_orderstatus = 'F' AS detected
  FROM orders)"""
SUMMARY = """summary AS (
  SELECT sample, nv, dv, ne, de,
         CASE WHEN nv > 0 THEN 'vti' WHEN ne > 0 THEN 'existing' END AS report,
         CASE WHEN nv > 0 THEN nv ELSE ne END AS engines,
         CASE WHEN nv > 0 THEN dv ELSE de END AS detections
  FROM (SELECT sample,
               count(*) FILTER (WHERE report = 'vti') AS nv,
               count(*) FILTER (WHERE report = 'vti' AND detected) AS dv,
               count(*) FILTER (WHERE report = 'existing') AS ne,
               count(*) FILTER (WHERE report = 'existing' AND detected) AS de
        FROM scans GROUP BY sample))"""
RESOLVED = f"""{SAMPLES},
{SCANS},
{SUMMARY},
resolved AS (
  SELECT s.sample, s.source, s.label, m.report, m.engines, m.detections,
         CASE WHEN s.label = 'malware' THEN 1e0 WHEN s.label = 'benign' THEN 0e0 END AS explicit_label,
         CASE WHEN m.detections IS NULL THEN NULL WHEN m.detections > 5 THEN 1e0 ELSE 0e0 END AS scan_label,
         coalesce(CASE WHEN s.label = 'malware' THEN 1e0 WHEN s.label = 'benign' THEN 0e0 END,
                  CASE WHEN m.detections IS NULL THEN NULL WHEN m.detections > 5 THEN 1e0 ELSE 0e0 END) AS label_value
  FROM samples s LEFT JOIN summary m USING (sample))"""
BALANCED = """known AS (SELECT sample, label_value FROM {src} WHERE label_value IN (0.0, 1.0)),
nmin AS (SELECT min(n) AS n FROM (SELECT count(*) AS n FROM known GROUP BY label_value)),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY label_value
                               ORDER BY md5(':' || CAST(sample AS VARCHAR)), sample) AS r
  FROM known),
balanced AS (SELECT sample, label_value FROM ranked, nmin WHERE r <= nmin.n)"""
UPLOADS = """uploads AS (
  SELECT o_custkey AS sample, printf('%032x', o_orderkey) AS uuid, 0 AS run_id, o_orderkey AS orderkey,
         CASE o_orderstatus WHEN 'F' THEN 'OK' WHEN 'O' THEN 'ERR' WHEN 'P' THEN 'WARN' END AS status,
         CASE WHEN o_orderpriority = '5-LOW' THEN 'pack-9' ELSE 'pack-1' END AS extractor_pack,
         o_orderdate AS ts, o_totalprice AS price
  FROM orders)"""
FEATURES = """features AS (
  SELECT o.o_custkey AS sample, per.l_orderkey AS orderkey, per.n_feature_sets
  FROM (SELECT l_orderkey, count(*) FILTER (WHERE l_linestatus = 'F') AS n_feature_sets
        FROM lineitem GROUP BY l_orderkey) per
  JOIN orders o ON per.l_orderkey = o.o_orderkey)"""


def _resolved(spark: SparkSession, sf_dir: str, **kw) -> DataFrame:
    return L.label_samples(A.customer_samples(spark, sf_dir), A.order_scans(spark, sf_dir), **kw)


# -- labelling (L1-L6, A5, A6) ---------------------------------------------

@register("label_by_count", f"""WITH {SAMPLES}, {SCANS}, {SUMMARY}
SELECT s.sample, m.report, m.engines, m.detections,
       CASE WHEN m.detections IS NULL THEN NULL WHEN m.detections > 5 THEN 1e0 ELSE 0e0 END AS label
FROM samples s LEFT JOIN summary m USING (sample)""")
def label_by_count(spark, sf_dir):
    """Detections of the vti report if present else existing (L1, A5); malware iff > 5 (L2)."""
    r = _resolved(spark, sf_dir)
    return r.select("sample", "report", "engines", "detections", F.col("scan_label").alias("label"))


@register("label_by_percent", f"""WITH {SAMPLES}, {SCANS}, {SUMMARY}
SELECT s.sample, m.engines, m.detections,
       CASE WHEN m.engines IS NULL OR m.engines = 0 THEN NULL
            WHEN CAST(m.detections AS DOUBLE) / m.engines * 100 > 40 THEN 1e0 ELSE 0e0 END AS label
FROM samples s LEFT JOIN summary m USING (sample)""")
def label_by_percent(spark, sf_dir):
    """Malware iff detections / engines * 100 > 40 (L3)."""
    r = _resolved(spark, sf_dir, pcount_perc=40.0)
    return r.select("sample", "engines", "detections", F.col("scan_label").alias("label"))


@register("resolve_label", f"""WITH {RESOLVED}
SELECT sample, explicit_label, scan_label, label_value FROM resolved""")
def resolve_label(spark, sf_dir):
    """Explicit label first, then scan label."""
    return _resolved(spark, sf_dir).select("sample", "explicit_label", "scan_label", "label_value")


@register("class_counts", f"""WITH {RESOLVED}
SELECT count(*) FILTER (WHERE label_value = 1.0) AS malware,
       count(*) FILTER (WHERE label_value = 0.0) AS benign,
       count(*) FILTER (WHERE label_value IN (0.0, 1.0)) AS total
FROM resolved""")
def class_counts(spark, sf_dir):
    """malware / benign / total."""
    return L.class_counts(_resolved(spark, sf_dir))


@register("balance_classes", f"""WITH {RESOLVED},
{BALANCED.format(src='resolved')}
SELECT sample, label_value AS label FROM balanced""")
def balance_classes(spark, sf_dir):
    """Both classes cut to the smaller one, survivors first in md5 order."""
    known = _resolved(spark, sf_dir).where(F.col("label_value").isin(0.0, 1.0)).select("sample", "label_value")
    return U.balance_classes(known, "label_value", "sample").select("sample", F.col("label_value").alias("label"))


@register("build_sample_set", f"""WITH {RESOLVED}, {FEATURES},
featured AS (SELECT * FROM resolved WHERE sample IN (SELECT sample FROM features WHERE n_feature_sets > 0)),
{BALANCED.format(src='featured')}
SELECT 'all' AS name, sample, label_value AS label FROM balanced""")
def build_sample_set(spark, sf_dir):
    """Labelled samples with non-empty features, balanced, named."""
    feats = A.order_features(spark, sf_dir).where(F.col("n_feature_sets") > 0)
    return L.build_sample_set(_resolved(spark, sf_dir), feats, "all")


@register("k_fold_split", f"""WITH {RESOLVED}
SELECT sample, CAST(('0x' || substr(md5('7:' || CAST(sample AS VARCHAR)), 1, 8))::BIGINT % 10 AS INTEGER) AS fold
FROM resolved WHERE label_value IN (0.0, 1.0)""")
def k_fold_split(spark, sf_dir):
    """Every labelled sample in exactly one of 10 folds by seeded md5 (U4)."""
    known = _resolved(spark, sf_dir).where(F.col("label_value").isin(0.0, 1.0)).select("sample")
    return U.k_fold(known, "sample", k=10, seed=7, method="md5")


@register("overlapping_subsets", f"""WITH {RESOLVED},
{BALANCED.format(src='resolved')},
size AS (SELECT floor(min(n) / 3) AS s FROM (SELECT count(*) AS n FROM balanced GROUP BY label_value)),
sets AS (SELECT b.*, CAST(i AS INTEGER) AS set_id FROM balanced b CROSS JOIN range(0, 4) t(i)),
rk AS (
  SELECT *, row_number() OVER (PARTITION BY set_id, label_value
        ORDER BY md5(':' || CAST(set_id AS VARCHAR) || ':' || CAST(sample AS VARCHAR)),
                 CAST(set_id AS VARCHAR) || ':' || CAST(sample AS VARCHAR)) AS r
  FROM sets)
SELECT set_id, sample, label_value AS label FROM rk, size WHERE r <= size.s""")
def overlapping_subsets(spark, sf_dir):
    """Four class-balanced subsets of a third of each class, overlapping."""
    known = _resolved(spark, sf_dir).where(F.col("label_value").isin(0.0, 1.0)).select("sample", "label_value")
    bal = U.balance_classes(known, "label_value", "sample")
    out = U.overlapping_subsets(bal, 4, "label_value", "sample")
    return out.select("set_id", "sample", F.col("label_value").alias("label"))


_NEXT_BATCH_SQL = f"""WITH {RESOLVED},
proc AS (SELECT DISTINCT o_custkey AS sample FROM orders WHERE o_orderstatus = 'F'),
ex AS (SELECT count(*) FILTER (WHERE label_value = 1.0) AS m, count(*) FILTER (WHERE label_value = 0.0) AS b
       FROM resolved WHERE sample IN (SELECT sample FROM proc)),
cand AS (SELECT sample, label_value, md5(':' || CAST(sample AS VARCHAR)) AS h
         FROM resolved WHERE sample NOT IN (SELECT sample FROM proc)),
lv AS (
  SELECT sample, label_value AS label, 0 AS cls, h,
         (SELECT m FROM ex) + row_number() OVER (ORDER BY h, sample) - 1 AS lvl
  FROM cand WHERE label_value = 1.0
  UNION ALL
  SELECT sample, label_value, 1, h, (SELECT b FROM ex) + row_number() OVER (ORDER BY h, sample) - 1
  FROM cand WHERE label_value = 0.0
  UNION ALL
  SELECT sample, CAST(NULL AS DOUBLE), 2, h, row_number() OVER (ORDER BY h, sample) - 1
  FROM cand WHERE label_value IS NULL),
o AS (SELECT *, row_number() OVER (ORDER BY (cls = 2), lvl, cls, h, sample) AS pick FROM lv)
SELECT CAST(pick AS INTEGER) AS pick, sample, label FROM o WHERE pick <= 50"""


@register("next_batch", _NEXT_BATCH_SQL)
def next_batch(spark, sf_dir):
    """Up to 50 unprocessed samples picked toward class balance, no repeats."""
    res = _resolved(spark, sf_dir)
    proc = A.order_uploads(spark, sf_dir).where(F.col("status") == "OK").select("sample").distinct()
    counts = L.class_counts(res.join(proc, "sample", "left_semi")).first()
    cand = J.unprocessed(res, proc)
    return U.next_batch(cand, counts["malware"], counts["benign"], queue_depth=0)


# -- uploads quality (A1-A4, J1, J8, K2, S7) -------------------------------

@register("status_breakdown", f"""WITH {UPLOADS}
SELECT status, n, round(n * 100.0 / sum(n) OVER (), 6) AS pct
FROM (SELECT status, count(*) AS n FROM uploads GROUP BY status)""")
def status_breakdown(spark, sf_dir):
    """Uploads per status and share of all uploads (A1)."""
    s = Q.status_breakdown(A.order_uploads(spark, sf_dir))
    return s.select("status", "n", _r6(F.col("pct")).alias("pct"))


@register("distinct_by_source", f"""WITH {UPLOADS}, {SAMPLES}
SELECT u.status, s.source, count(DISTINCT u.sample) AS n_samples
FROM uploads u JOIN samples s USING (sample) GROUP BY ALL""")
def distinct_by_source(spark, sf_dir):
    """Distinct samples per status and source."""
    return Q.distinct_by_source(A.order_uploads(spark, sf_dir), A.customer_samples(spark, sf_dir))


@register("featured_by_source", f"""WITH {UPLOADS}, {SAMPLES}, {FEATURES},
good AS (SELECT DISTINCT u.sample, s.source FROM uploads u JOIN samples s USING (sample) WHERE u.status = 'OK'),
f AS (SELECT DISTINCT sample FROM features WHERE n_feature_sets > 0)
SELECT source, count(DISTINCT sample) AS n_good,
       count(DISTINCT sample) FILTER (WHERE sample IN (SELECT sample FROM f)) AS n_featured
FROM good GROUP BY source""")
def featured_by_source(spark, sf_dir):
    """Of the good samples per source, those with > 0 feature sets (A3)."""
    return Q.featured_by_source(
        A.order_uploads(spark, sf_dir), A.customer_samples(spark, sf_dir), A.order_features(spark, sf_dir)
    )


@register("list_for_source", f"""WITH {UPLOADS}, {SAMPLES}, {FEATURES},
up AS (SELECT u.sample, u.status FROM uploads u JOIN samples s USING (sample) WHERE s.source = 'NATION_3'),
good AS (SELECT DISTINCT sample FROM up WHERE status = 'OK')
SELECT DISTINCT 'bad' AS list, sample FROM up WHERE status = 'ERR'
UNION ALL SELECT 'good', sample FROM good
UNION ALL SELECT 'featured', sample FROM good
  WHERE sample IN (SELECT sample FROM features WHERE n_feature_sets > 0)""")
def list_for_source(spark, sf_dir):
    """Bad, good and featured sample ids of one source (A4)."""
    return Q.list_for_source(
        A.order_uploads(spark, sf_dir), A.customer_samples(spark, sf_dir), A.order_features(spark, sf_dir), "NATION_3"
    )


@register("pack_feature_map", f"""WITH {UPLOADS}
SELECT sample, orderkey, extractor_pack, 'mem_rw_dump' AS family, 'ext-mem-rw-dump' AS extractor
FROM uploads WHERE extractor_pack = 'pack-1'""")
def pack_feature_map(spark, sf_dir):
    """Feature family and extractor of each upload's pack; unknown packs drop."""
    m = J.pack_feature_map(A.order_uploads(spark, sf_dir))
    return m.select("sample", "orderkey", "extractor_pack", "family", "extractor")


@register("search_uploads", f"""WITH {UPLOADS}
SELECT sample, orderkey, status FROM uploads WHERE extractor_pack = 'pack-1' AND status = 'OK'""")
def search_uploads(spark, sf_dir):
    """Conjunctive optional filters: pack, feature family (S7), then status."""
    from ..sources.readers import search_uploads as su

    s = su(A.order_uploads(spark, sf_dir), extractor_pack="pack-1", feature_family="mem_rw_dump")
    return s.where(F.col("status") == "OK").select("sample", "orderkey", "status")


@register("skip_existing", f"""WITH {UPLOADS}, {FEATURES}
SELECT sample, orderkey FROM uploads
WHERE status <> 'ERR' AND orderkey NOT IN (SELECT orderkey FROM features WHERE n_feature_sets > 0)""")
def skip_existing(spark, sf_dir):
    """Successful uploads that still need extraction: existing outputs skipped."""
    from ..sources.sinks import skip_existing as se

    up = A.order_uploads(spark, sf_dir).where(CF.run_ok(F.col("status")))
    done = A.order_features(spark, sf_dir).where(F.col("n_feature_sets") > 0)
    return se(up, done, ["orderkey"]).select("sample", "orderkey")


# -- catalogue and id sets (F4-F6, J4-J6, U1, U9) ---------------------------

DOCS = """docs AS (
  SELECT doc_id, sha256(text) AS sample, lang, source,
         CASE lang WHEN 'en' THEN 'PE32 executable (GUI) Intel 80386, for MS Windows'
                   WHEN 'de' THEN 'PE32+ executable (GUI) x86-64, for MS Windows'
                   WHEN 'fr' THEN 'PE32 executable (DLL) (GUI) Intel 80386, for MS Windows'
                   WHEN 'es' THEN 'ELF 64-bit LSB executable, x86-64' END AS file_type
  FROM documents)"""
INFLIGHT = f"""{DOCS},
catalogue AS (SELECT DISTINCT sample FROM docs),
uploaded AS (SELECT sample FROM docs WHERE doc_id IN (SELECT doc_id FROM labels)),
queued AS (SELECT sample FROM docs WHERE lang = 'fr'),
processing AS (SELECT sample FROM docs WHERE source = 'src0'),
inflight AS (SELECT sample FROM uploaded UNION SELECT sample FROM queued UNION SELECT sample FROM processing)"""


def _doc_sets(spark, sf_dir):
    d = A.document_binaries(spark, sf_dir)
    labels = A.table(spark, sf_dir, "labels")
    catalogue = d.select("sample").distinct()
    uploaded = d.join(labels, "doc_id", "left_semi").select("sample")
    queued = d.where(F.col("lang") == "fr").select("sample")
    processing = d.where(F.col("source") == "src0").select("sample")
    return d, catalogue, uploaded, queued, processing


@register("in_flight_union", f"""WITH {INFLIGHT} SELECT sample FROM inflight""")
def in_flight_union(spark, sf_dir):
    """Distinct union of uploaded, queued and processing ids."""
    _, _, up, q, p = _doc_sets(spark, sf_dir)
    return U.in_flight_union(up, q, p)


@register("unprocessed", f"""WITH {INFLIGHT}
SELECT sample FROM catalogue WHERE sample NOT IN (SELECT sample FROM inflight)""")
def unprocessed(spark, sf_dir):
    """Catalogue samples not in flight."""
    _, cat, up, q, p = _doc_sets(spark, sf_dir)
    return J.unprocessed(cat, U.in_flight_union(up, q, p))


@register("samples_without_upload", f"""WITH {INFLIGHT}
SELECT sample FROM catalogue WHERE sample NOT IN (SELECT sample FROM uploaded)""")
def samples_without_upload(spark, sf_dir):
    """Catalogue minus uploaded samples."""
    _, cat, up, _, _ = _doc_sets(spark, sf_dir)
    return J.samples_without_upload(cat, up)


@register("samples_without_metadata", f"""WITH {INFLIGHT}
SELECT sample FROM catalogue WHERE sample NOT IN (SELECT sample FROM docs WHERE lang <> 'es')""")
def samples_without_metadata(spark, sf_dir):
    """Catalogue minus samples that have a metadata document."""
    d, cat, _, _, _ = _doc_sets(spark, sf_dir)
    return J.samples_without_metadata(cat, d.where(F.col("lang") != "es"))


@register("dedup_by_content", f"""WITH {DOCS}
SELECT sample, min(doc_id) AS doc_id, arg_min(lang, doc_id) AS lang, arg_min(source, doc_id) AS source
FROM docs GROUP BY sample""")
def dedup_by_content(spark, sf_dir):
    """One entry per SHA-256 of the content, smallest id survives."""
    d = A.document_binaries(spark, sf_dir).select("sample", "doc_id", "lang", "source")
    return U.dedup_by_content(d, "sample", "doc_id")


@register("sample_catalogue", f"""WITH {DOCS}
SELECT doc_id, sample, regexp_matches(sample, '^[A-Za-z0-9]{{64}}$') AS is_sample_name,
       starts_with(file_type, 'PE32') AND NOT contains(file_type, '(DLL)') AS valid_pe,
       CASE WHEN contains(file_type, 'PE32+') THEN '64' WHEN contains(file_type, 'PE') THEN '32' END AS arch
FROM docs""")
def sample_catalogue(spark, sf_dir):
    """Name check, PE validity and architecture of catalogue entries."""
    d = A.document_binaries(spark, sf_dir)
    return d.select(
        "doc_id", "sample", CF.is_sha256_name(F.col("sample")).alias("is_sample_name"),
        CF.valid_pe(F.col("file_type")).alias("valid_pe"), CF.arch_of(F.col("file_type")).alias("arch"),
    )


@register("upsert_latest", """
SELECT user_id AS id, arg_max(event_id, (ts, event_id)) AS event_id,
       arg_max(event_type, (ts, event_id)) AS event_type
FROM events GROUP BY user_id""")
def upsert_latest(spark, sf_dir):
    """Replace-on-same-id semantics: latest version per document id (K3-K5)."""
    from ..sources.sinks import latest_version

    e = A.table(spark, sf_dir, "events").select(F.col("user_id").alias("id"), "ts", "event_id", "event_type")
    return latest_version(e, ["id"], ["ts", "event_id"]).select("id", "event_id", "event_type")


# -- upload metadata scalars (F7, F10-F13, F16-F18) ---------------------------

_UPLOAD_REPORT_SQL = """WITH u AS (
  SELECT o_orderkey AS orderkey, o_custkey AS sample, printf('%032x', o_orderkey) AS uuid, 0 AS run_id,
         CASE o_orderstatus WHEN 'F' THEN 'OK' WHEN 'O' THEN 'ERR' WHEN 'P' THEN 'WARN' END AS status,
         CASE WHEN o_orderpriority = '1-URGENT' THEN strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') || '.250000'
              ELSE strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') END AS start_text,
         strftime(o_orderdate + to_microseconds(CAST(round(o_totalprice * 1000) AS BIGINT)), '%Y-%m-%d %H:%M:%S.%f') AS end_text,
         CASE WHEN o_orderstatus <> 'O' THEN CAST(round(o_totalprice * 100) AS BIGINT) END AS before_gz,
         CASE WHEN o_orderstatus <> 'O' THEN CAST(round(o_totalprice * 7) AS BIGINT) END AS after_gz,
         printf('%d.exe', o_orderkey) AS upload_name
  FROM orders),
p AS (SELECT *, epoch_us(CAST(end_text AS TIMESTAMP)) - epoch_us(CAST(start_text AS TIMESTAMP)) AS dur_us FROM u)
SELECT orderkey,
       CAST(sample AS VARCHAR) || '-' || uuid || '-' || CAST(run_id AS VARCHAR) AS doc_id,
       CAST(sample AS VARCHAR) AS doc_sample,
       round(dur_us / 1000000.0, 6) AS duration_s,
       CASE WHEN dur_us / 1000000.0 >= 180 THEN 'WARN' WHEN before_gz IS NOT NULL THEN 'OK' ELSE 'ERR' END AS run_status,
       CASE WHEN dur_us / 1000000.0 >= 180 THEN 'breached agent timeout (3m)'
            WHEN before_gz IS NOT NULL THEN 'uploading' ELSE 'no_file_to_upload' END AS status_msg,
       round(CAST(after_gz AS DOUBLE) / before_gz, 6) AS compression,
       3 - run_id - 1 AS runs_left,
       status IS NOT NULL AND status <> 'ERR' AS run_ok,
       regexp_replace(upload_name, '\\.exe$', '') AS name
FROM p"""


@register("upload_report", _UPLOAD_REPORT_SQL)
def upload_report(spark, sf_dir):
    """Per upload: timestamps parsed with/without fraction, duration, status of
    the run, gzip ratio, runs left, success, document id (F7, F10-F13, F16-F18)."""
    o = A.table(spark, sf_dir, "orders")
    start_fmt = F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss")
    start_text = F.when(F.col("o_orderpriority") == "1-URGENT", F.concat(start_fmt, F.lit(".250000"))).otherwise(start_fmt)
    end_ts = F.timestamp_add("MICROSECOND", F.round(F.col("o_totalprice") * 1000).cast("long"), F.col("o_orderdate"))
    status = F.when(F.col("o_orderstatus") == "F", "OK").when(F.col("o_orderstatus") == "O", "ERR").when(
        F.col("o_orderstatus") == "P", "WARN"
    )
    present = F.col("o_orderstatus") != "O"
    u = o.select(
        F.col("o_orderkey").alias("orderkey"), F.col("o_custkey").alias("sample"),
        F.format_string("%032x", F.col("o_orderkey")).alias("uuid"), F.lit(0).alias("run_id"),
        status.alias("status"), start_text.alias("start_text"),
        F.date_format(end_ts, "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("end_text"),
        F.when(present, F.round(F.col("o_totalprice") * 100).cast("long")).alias("before_gz"),
        F.when(present, F.round(F.col("o_totalprice") * 7).cast("long")).alias("after_gz"),
        F.format_string("%d.exe", F.col("o_orderkey")).alias("upload_name"),
    )
    dur = CF.run_duration_seconds(CF.parse_ts(F.col("start_text")), CF.parse_ts(F.col("end_text")))
    st = CF.status_of_run(F.col("before_gz"), F.col("duration_s"))
    return u.withColumn("duration_s", dur).select(
        "orderkey",
        CF.doc_id(F.col("sample"), F.col("uuid"), F.col("run_id")).alias("doc_id"),
        CF.sample_of_doc_id(CF.doc_id(F.col("sample"), F.col("uuid"), F.col("run_id"))).alias("doc_sample"),
        _r6(F.col("duration_s")).alias("duration_s"),
        st["status"].alias("run_status"),
        st["status_msg"].alias("status_msg"),
        _r6(CF.compression_ratio(F.col("before_gz"), F.col("after_gz"))).alias("compression"),
        CF.runs_left(F.lit(3), F.col("run_id")).alias("runs_left"),
        CF.run_ok(F.col("status")).alias("run_ok"),
        CF.strip_exe(F.col("upload_name")).alias("name"),
    )


# -- metrics (A7, A9, E1-E8, M11) ------------------------------------------

PAIRS = """pairs AS (
  SELECT l.doc_id, CAST(l.quality AS DOUBLE) AS label, CAST(1 - l.toxic AS DOUBLE) AS prediction,
         d.lang, CAST(d.n_chars AS DOUBLE) AS score
  FROM labels l LEFT JOIN documents d USING (doc_id))"""
_METRIC_SQL = """tp, tn, fp, fn,
  round(CASE WHEN n = 0 THEN 0 ELSE (tp + tn) / n END, 6) AS accuracy,
  round(CASE WHEN n = 0 THEN 0 ELSE (tp + fn) / n END, 6) AS positive_rate,
  round(prec, 6) AS precision, round(rec, 6) AS recall, round(spec, 6) AS specificity,
  round(CASE WHEN rec + prec = 0 THEN 0 ELSE 2 * (rec * prec) / (rec + prec) END, 6) AS f1,
  round((rec + spec) / 2, 6) AS auroc_hard"""
_METRIC_SQL_RAW = """
  CASE WHEN n = 0 THEN 0 ELSE (tp + tn) / n END AS accuracy, prec AS precision, rec AS recall,
  spec AS specificity, CASE WHEN rec + prec = 0 THEN 0 ELSE 2 * (rec * prec) / (rec + prec) END AS f1,
  (rec + spec) / 2 AS auroc_hard"""
_COUNTS_SQL = """(SELECT {g} tp, tn, fp, fn, CAST(tp + tn + fp + fn AS DOUBLE) AS n,
         CASE WHEN tp + fp = 0 THEN 0 ELSE tp / (tp + fp) END AS prec,
         CASE WHEN tp + fn = 0 THEN 0 ELSE tp / (tp + fn) END AS rec,
         CASE WHEN tn + fp = 0 THEN 0 ELSE tn / (tn + fp) END AS spec
  FROM (SELECT {g}
          CAST(count(*) FILTER (WHERE label = 1 AND prediction = 1) AS DOUBLE) AS tp,
          CAST(count(*) FILTER (WHERE label = 0 AND prediction = 0) AS DOUBLE) AS tn,
          CAST(count(*) FILTER (WHERE label = 0 AND prediction = 1) AS DOUBLE) AS fp,
          CAST(count(*) FILTER (WHERE label = 1 AND prediction = 0) AS DOUBLE) AS fn
        FROM {src} {groupby}))"""


def _pairs(spark, sf_dir):
    lab = A.table(spark, sf_dir, "labels")
    docs = A.table(spark, sf_dir, "documents").select("doc_id", "lang", "n_chars")
    return lab.join(docs, "doc_id", "left").select(
        "doc_id", F.col("quality").cast("double").alias("label"), (1 - F.col("toxic")).cast("double").alias("prediction"),
        "lang", F.col("n_chars").cast("double").alias("score"),
    )


def _metric_out(m: DataFrame, groups) -> DataFrame:
    return m.select(
        *groups, *[F.col(c).cast("double").alias(c) for c in ("tp", "tn", "fp", "fn")],
        *[_r6(F.col(c)).alias(c) for c in ("accuracy", "positive_rate", "precision", "recall", "specificity", "f1", "auroc_hard")],
    )


@register("confusion_metrics", f"""WITH {PAIRS}
SELECT {_METRIC_SQL} FROM {_COUNTS_SQL.format(g='', src='pairs', groupby='')}""")
def confusion_metrics(spark, sf_dir):
    """TP/TN/FP/FN, accuracy (correct and reference's), precision, recall,
    specificity, F1, hard AuROC; 0 on empty denominators (A7, E1-E7)."""
    return _metric_out(M.confusion_metrics(_pairs(spark, sf_dir)), [])


@register("auroc_scores", f"""WITH {PAIRS},
ps AS (SELECT lang, score, count(*) FILTER (WHERE label = 1) AS p, count(*) FILTER (WHERE label = 0) AS n
       FROM pairs GROUP BY lang, score),
cum AS (SELECT *, coalesce(sum(n) OVER (PARTITION BY lang ORDER BY score ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS below
        FROM ps)
SELECT lang, CAST(sum(p) AS BIGINT) AS n_pos, CAST(sum(n) AS BIGINT) AS n_neg,
       round(CASE WHEN sum(p) * sum(n) = 0 THEN 0 ELSE sum(p * (below + n / 2.0)) / (sum(p) * sum(n)) END, 6) AS auroc
FROM cum GROUP BY lang""")
def auroc_scores(spark, sf_dir):
    """Exact AuROC of document length as a quality score, per language, ties averaged."""
    a = M.auroc(_pairs(spark, sf_dir), "score", "label", ["lang"])
    return a.select("lang", "n_pos", "n_neg", _r6(F.col("auroc")).alias("auroc"))


_FOLD = "CAST(('0x' || substr(md5('3:' || CAST(doc_id AS VARCHAR)), 1, 8))::BIGINT % 10 AS INTEGER)"


@register("mean_over_folds", f"""WITH {PAIRS},
f AS (SELECT *, {_FOLD} AS fold FROM pairs),
per AS (SELECT lang, fold, {_METRIC_SQL_RAW} FROM {_COUNTS_SQL.format(g='lang, fold,', src='f', groupby='GROUP BY lang, fold')})
SELECT lang, round(avg(accuracy), 6) AS accuracy, round(avg(precision), 6) AS precision,
       round(avg(recall), 6) AS recall, round(avg(specificity), 6) AS specificity,
       round(avg(f1), 6) AS f1, round(avg(auroc_hard), 6) AS auroc
FROM per GROUP BY lang""")
def mean_over_folds(spark, sf_dir):
    """Per-fold metrics over 10 md5 folds, averaged per language."""
    f = U.k_fold(_pairs(spark, sf_dir), "doc_id", k=10, seed=3, method="md5")
    per = M.confusion_metrics(f, groups=["lang", "fold"]).withColumnRenamed("auroc_hard", "auroc")
    m = M.mean_over_folds(per, ["lang"])
    return m.select("lang", *[_r6(F.col(c)).alias(c) for c in M.METRIC_COLS])


@register("metrics_report", f"""WITH {PAIRS},
m AS (SELECT lang, {_METRIC_SQL} FROM {_COUNTS_SQL.format(g='lang,', src='pairs', groupby='GROUP BY lang')})
SELECT lang,
       coalesce(lang, 'None') || '/rule/None,' || printf('%.6f', accuracy) || ',' || printf('%.6f', precision) || ','
         || printf('%.6f', recall) || ',' || printf('%.6f', specificity) || ',' || printf('%.6f', f1) || ','
         || printf('%.6f', auroc_hard) AS csv
FROM m""")
def metrics_report(spark, sf_dir):
    """CSV rendering of the metric rows per language."""
    m = _metric_out(M.confusion_metrics(_pairs(spark, sf_dir), groups=["lang"]), ["lang"])
    m = m.withColumn("classifier", F.lit("rule")).withColumn("normaliser", F.lit(None).cast("string")).withColumnRenamed(
        "auroc_hard", "auroc"
    )
    r = M.metrics_report(m, ["lang", "classifier", "normaliser"])
    return r.select("lang", "csv")


@register("ensemble_vote", f"""WITH {PAIRS},
votes AS (
  SELECT doc_id, prediction AS v FROM pairs
  UNION ALL SELECT doc_id, CASE WHEN score > 1000 THEN 1e0 ELSE 0e0 END FROM pairs
  UNION ALL SELECT doc_id, CASE WHEN lang = 'en' THEN 1e0 ELSE 0e0 END FROM pairs)
SELECT doc_id, CASE WHEN 2 * sum(v) > count(*) THEN 1e0 ELSE 0e0 END AS vote, CAST(count(*) AS BIGINT) AS n_models
FROM votes GROUP BY doc_id""")
def ensemble_vote(spark, sf_dir):
    """Majority vote of three rule-based models per document; ties -> 0."""
    from ..operators.ml import ensemble_vote as vote

    p = _pairs(spark, sf_dir)
    long = (
        p.select("doc_id", F.lit("toxicity").alias("model"), F.col("prediction"))
        .unionByName(p.select("doc_id", F.lit("length").alias("model"), F.when(F.col("score") > 1000, 1.0).otherwise(0.0).alias("prediction")))
        .unionByName(p.select("doc_id", F.lit("lang").alias("model"), F.when(F.col("lang") == "en", 1.0).otherwise(0.0).alias("prediction")))
    )
    return vote(long, "doc_id")


# -- runs, heartbeats, work state (W3-W7 batch forms) ---------------------------

@register("run_counter", """
SELECT user_id AS uuid, event_id, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1 AS run_id
FROM events""")
def run_counter(spark, sf_dir):
    """Per-uuid run number 0, 1, 2, ... in arrival order (W5, batch form)."""
    e = A.table(spark, sf_dir, "events").select(
        F.col("user_id").alias("uuid"), "event_id", "ts", CF.epoch_us(F.col("ts")).alias("_us")
    )
    p = ordered_positions(e, ["uuid"], ["_us", "event_id"], adaptive=True)
    return p.select("uuid", "event_id", (F.col("pos") - 1).alias("run_id"))


_LIVENESS = """hb AS (SELECT user_id AS node, max(ts) AS last_ts FROM events GROUP BY user_id),
now AS (SELECT max(ts) AS now_ts FROM events),
live AS (
  SELECT c.c_custkey AS node, epoch_us(hb.last_ts) AS last_seen_us,
         round((epoch_us(now.now_ts) - epoch_us(hb.last_ts)) / 1000000.0, 6) AS idle_s,
         hb.last_ts IS NULL OR (epoch_us(now.now_ts) - epoch_us(hb.last_ts)) > 300000000 AS expired
  FROM customer c CROSS JOIN now LEFT JOIN hb ON hb.node = c.c_custkey)"""


@register("node_liveness", f"""WITH {_LIVENESS} SELECT * FROM live""")
def node_liveness(spark, sf_dir):
    """Last heartbeat per node; expired when never seen or idle > 300 s (W3, batch form)."""
    from ..streaming.liveness import node_liveness as nl

    nodes = A.table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("node"))
    hb = A.table(spark, sf_dir, "events").select(F.col("user_id").alias("node"), "ts")
    out = nl(nodes, hb)
    return out.select("node", "last_seen_us", _r6(F.col("idle_s")).alias("idle_s"), "expired")


@register("timeout_runs", f"""WITH {_LIVENESS}
SELECT o.o_custkey AS node, o.o_orderkey AS orderkey, 'ERR' AS status, 'vm watchdog timeout' AS status_msg
FROM orders o JOIN live ON live.node = o.o_custkey
WHERE live.expired AND o.o_orderstatus = 'P'""")
def timeout_runs(spark, sf_dir):
    """In-flight work of expired nodes becomes an ERR run (W4, batch form)."""
    from ..streaming.liveness import node_liveness as nl, timeout_runs as tr

    nodes = A.table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("node"))
    hb = A.table(spark, sf_dir, "events").select(F.col("user_id").alias("node"), "ts")
    work = A.table(spark, sf_dir, "orders").where(F.col("o_orderstatus") == "P").select(
        F.col("o_custkey").alias("node"), F.col("o_orderkey").alias("orderkey")
    )
    return tr(nl(nodes, hb), work).select("node", "orderkey", "status", "status_msg")


@register("queue_depths", """
SELECT CASE o_orderstatus WHEN 'O' THEN 'pending' WHEN 'P' THEN 'processing' ELSE 'done' END AS state,
       count(*) AS n
FROM orders GROUP BY 1""")
def queue_depths(spark, sf_dir):
    """Pending / processing / done work item counts."""
    from ..streaming.liveness import queue_depths as qd

    o = A.table(spark, sf_dir, "orders")
    work = o.select(
        F.when(F.col("o_orderstatus") == "O", "pending").when(F.col("o_orderstatus") == "P", "processing")
        .otherwise("done").alias("state")
    )
    return qd(work)


@register("in_process_check", """
SELECT o_custkey AS node, count(*) AS n_in_process FROM orders WHERE o_orderstatus = 'P'
GROUP BY o_custkey HAVING count(*) > 1""")
def in_process_check(spark, sf_dir):
    """Nodes holding more than one in-flight item."""
    from ..streaming.liveness import in_process_check as ipc

    work = A.table(spark, sf_dir, "orders").where(F.col("o_orderstatus") == "P").select(
        F.col("o_custkey").alias("node"), F.col("o_orderkey").alias("orderkey")
    )
    return ipc(work)

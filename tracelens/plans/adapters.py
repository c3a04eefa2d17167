"""Stand-in inputs built from the driver's test tables.

The reference ships no traces, uploads or scan reports, so each operator's
input is derived from a test table with a plain projection.  An adapter only
renames and recasts columns into the schema the operator expects; it does no
part of the operator's work.  Every adapter has a textual twin in
``plans.oracle`` so DuckDB sees exactly the same input.
"""

from __future__ import annotations

import os

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


# -- traces -----------------------------------------------------------------

# Chunk sizes and histogram ranges for the stand-in traces (parameters of the
# test, not of the engine): events traces hold about 1,000 rows per sample at
# sf0.01, so the grid uses chunks of 50/100/250.
EVENTS_CHUNKS = (50, 100, 250)
EVENTS_RANGES = {50: (-500000, 500000), 100: (-500000, 500000), 250: (-500000, 500000)}
LINEITEM_CHUNKS = (50, 100, 250)
LINEITEM_RANGES = {50: (-2000000000, 2000000000), 100: (-4000000000, 4000000000), 250: (-10000000000, 10000000000)}
TRACE_KEYS = ("sample", "uuid", "run_id")
LINEITEM_ORDER = (
    "l_orderkey", "l_linenumber", "l_partkey", "l_quantity", "l_extendedprice",
    "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate",
)


def events_trace(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trace rows from ``events``: sample = user_id mod 10, seq = event_id,
    view/error -> R else W, target = value in cents."""
    e = table(spark, sf_dir, "events")
    return e.select(
        F.format_string("s%d", F.col("user_id") % 10).alias("sample"),
        F.lit("u0").alias("uuid"),
        F.lit(0).alias("run_id"),
        F.col("event_id").alias("seq"),
        F.when(F.col("event_type").isin("view", "error"), "R").otherwise("W").alias("rw"),
        F.round(F.col("value") * 100).cast("long").alias("tgt"),
    )


def lineitem_trace(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trace rows from ``lineitem``: one trace per supplier, ordered by all
    columns (keys repeat), returnflag N -> R else W, target = price in cents."""
    li = table(spark, sf_dir, "lineitem")
    return li.select(
        F.format_string("p%d", F.col("l_suppkey")).alias("sample"),
        F.lit("u0").alias("uuid"),
        F.lit(0).alias("run_id"),
        *LINEITEM_ORDER,
        F.when(F.col("l_returnflag") == "N", "R").otherwise("W").alias("rw"),
        F.round(F.col("l_extendedprice") * 100).cast("long").alias("tgt"),
    )


# Base addresses added to event ids / cents to make tracer-like hex values.
TEXT_INS_BASE = 0x7FFD37CD0000
TEXT_TGT_BASE = 0x361957EC40


def events_trace_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tracer-style text lines from ``events`` (one line per event).

    Sizes cycle through 1, 2, 4, 8, 16 by user; signup events become comment
    lines.  Columns: ``sample, seq, value`` (the line).
    """
    e = table(spark, sf_dir, "events")
    size = F.expr("shiftleft(1, CAST(user_id % 5 AS INT))")
    rw = F.when(F.col("event_type").isin("view", "error"), "R").otherwise("W")
    line = F.when(
        F.col("event_type") == "signup", F.concat(F.lit("# "), F.col("props"))
    ).otherwise(
        F.format_string(
            "0x%016x: %s 0x%016x  %d  0x%x",
            F.col("event_id") + F.lit(TEXT_INS_BASE),
            rw,
            F.round(F.col("value") * 100).cast("long") + F.lit(TEXT_TGT_BASE),
            size,
            F.col("user_id"),
        )
    )
    return e.select(
        F.format_string("s%d", F.col("user_id") % 10).alias("sample"),
        F.col("event_id").alias("seq"),
        line.alias("value"),
    )


# -- catalogue, scans, uploads ----------------------------------------------

def customer_samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sample catalogue from ``customer``: sample = custkey, source = nation
    name, explicit label MACHINERY -> malware, HOUSEHOLD -> benign, else none."""
    c = table(spark, sf_dir, "customer")
    n = table(spark, sf_dir, "nation")
    label = F.when(F.col("c_mktsegment") == "MACHINERY", "malware").when(F.col("c_mktsegment") == "HOUSEHOLD", "benign")
    return c.join(n, c["c_nationkey"] == n["n_nationkey"], "left").select(
        F.col("c_custkey").alias("sample"), F.col("n_name").alias("source"), label.alias("label")
    )


def order_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scan reports in long form from ``orders``: one engine verdict per order;
    urgent/high orders form the vti report, the rest the existing report,
    detected = status F."""
    o = table(spark, sf_dir, "orders")
    return o.select(
        F.col("o_custkey").alias("sample"),
        F.when(F.col("o_orderpriority").isin("1-URGENT", "2-HIGH"), "vti").otherwise("existing").alias("report"),
        F.format_string("e%d", F.col("o_orderkey")).alias("engine"),
        (F.col("o_orderstatus") == "F").alias("detected"),
    )


def order_uploads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Uploads from ``orders``: one run per order of customer o_custkey;
    status F -> OK, O -> ERR, P -> WARN; pack-1 except priority 5-LOW
    (an unknown pack-9)."""
    o = table(spark, sf_dir, "orders")
    status = F.when(F.col("o_orderstatus") == "F", "OK").when(F.col("o_orderstatus") == "O", "ERR").when(
        F.col("o_orderstatus") == "P", "WARN"
    )
    return o.select(
        F.col("o_custkey").alias("sample"),
        F.format_string("%032x", F.col("o_orderkey")).alias("uuid"),
        F.lit(0).alias("run_id"),
        F.col("o_orderkey").alias("orderkey"),
        status.alias("status"),
        F.when(F.col("o_orderpriority") == "5-LOW", "pack-9").otherwise("pack-1").alias("extractor_pack"),
        F.col("o_orderdate").alias("ts"),
        F.col("o_totalprice").alias("price"),
    )


def order_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Feature documents: one per order with lineitems; its feature-set count
    is the number of lineitems with linestatus F (zero = empty document)."""
    li = table(spark, sf_dir, "lineitem")
    o = table(spark, sf_dir, "orders")
    per = li.groupBy("l_orderkey").agg(F.count_if(F.col("l_linestatus") == "F").alias("n_feature_sets"))
    return per.join(o, per["l_orderkey"] == o["o_orderkey"], "inner").select(
        F.col("o_custkey").alias("sample"), F.col("l_orderkey").alias("orderkey"), "n_feature_sets"
    )


# Fixed stand-in file types per document language (input data for F5/F6).
FILE_TYPES = {
    "en": "PE32 executable (GUI) Intel 80386, for MS Windows",
    "de": "PE32+ executable (GUI) x86-64, for MS Windows",
    "fr": "PE32 executable (DLL) (GUI) Intel 80386, for MS Windows",
    "es": "ELF 64-bit LSB executable, x86-64",
}


def document_binaries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Binary catalogue from ``documents``: content = text bytes, name =
    SHA-256 of the content, file type by language."""
    d = table(spark, sf_dir, "documents")
    ft = F.lit(None).cast("string")
    for lang, t in FILE_TYPES.items():
        ft = F.when(F.col("lang") == lang, F.lit(t)).otherwise(ft)
    return d.select(
        "doc_id", F.sha2(F.col("text"), 256).alias("sample"), F.col("text").cast("binary").alias("content"),
        "lang", "source", ft.alias("file_type"),
    )


def write_events_trace_files(spark: SparkSession, sf_dir: str, root: str, compression: str = "none") -> str:
    """Write the tracer text of ``events`` as one text file per trace under
    ``root/sample=<s>/uuid=u0/run_id=0/`` in line order; returns the glob."""
    lines = events_trace_text(spark, sf_dir).select(
        "sample", F.lit("u0").alias("uuid"), F.lit(0).alias("run_id"), "seq", "value"
    )
    (
        lines.repartition("sample", "uuid", "run_id")
        .sortWithinPartitions("sample", "uuid", "run_id", "seq")
        .select("sample", "uuid", "run_id", "value")
        .write.mode("overwrite")
        .partitionBy("sample", "uuid", "run_id")
        .option("compression", compression)
        .text(root)
    )
    return f"{root.rstrip('/')}/*/*/*/*.txt*"


def embedding_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labelled vectors from ``embeddings``: label = 1 when label >= 5."""
    e = table(spark, sf_dir, "embeddings")
    return e.select(
        F.col("vec_id").alias("sample"),
        F.col("embedding").cast("array<double>").alias("feature_data"),
        F.lit("embedding").alias("feature"),
        F.when(F.col("label") >= 5, 1.0).otherwise(0.0).alias("label"),
    )


def supplier_uploads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One upload per supplier trace: status ERR when the account balance is
    negative, else OK."""
    s = table(spark, sf_dir, "supplier")
    return s.select(
        F.format_string("p%d", F.col("s_suppkey")).alias("sample"),
        F.lit("u0").alias("uuid"),
        F.lit(0).alias("run_id"),
        F.when(F.col("s_acctbal") < 0, "ERR").otherwise("OK").alias("status"),
    )


def write_weekly_event_files(spark: SparkSession, sf_dir: str, root: str) -> str:
    """Write ``(uuid=user_id, event_id, ts)`` of ``events`` in one pass, a file
    a week, oldest first, so that a file stream with one file per trigger sees
    whole weeks in time order (file names carry the week; the files' times are set to match)."""
    from ..functions.catalog import epoch_us

    e = table(spark, sf_dir, "events").select(F.col("user_id").alias("uuid"), "event_id", "ts")
    return write_weekly_files(e, epoch_us(F.col("ts")), root)


def write_weekly_files(rows: DataFrame, us: Column, root: str) -> str:
    """Write rows with a time (epoch microseconds), a file a week, oldest first."""
    spark = rows.sparkSession
    wk = F.floor(us / F.lit(7 * 86400 * 1_000_000)).cast("long")
    weeks = rows.withColumn("w", F.format_string("%06d", wk)).repartition("w")
    weeks.write.mode("overwrite").partitionBy("w").parquet(root)
    fs_path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    system = fs_path(root).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    folders = sorted(str(f.getPath()) for f in system.globStatus(fs_path(f"{root}/w=*")))  # one a week
    for k, folder in enumerate(folders):
        for f in system.listStatus(fs_path(folder)):
            system.setTimes(f.getPath(), 1_000_000_000_000 + k * 1000, -1)
    return f"{root}/*"


def supplier_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A label per supplier trace: 1.0 when the account balance is above 4500."""
    s = table(spark, sf_dir, "supplier")
    return s.select(
        F.format_string("p%d", F.col("s_suppkey")).alias("sample"),
        F.when(F.col("s_acctbal") > 4500, 1.0).otherwise(0.0).alias("label"),
    )

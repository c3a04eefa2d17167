"""Sinks (K1-K10): feature tables, upserts, sample sets, metric CSV, models.

Writes are idempotent (overwrite of a partition / keyed replace), so a job
re-run after an executor or driver loss produces the same output.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.catalog import METADATA_VERSION_KEY
from ..functions.redact import redact_sample_document
from ..operators.chunks import FEATURE_FAMILY, FEATURE_VERSION
from ..operators.labelling import sample_set_document
from ..operators.metrics import metrics_csv


def latest_version(df: DataFrame, id_cols: Sequence[str], version_cols: Sequence[str]) -> DataFrame:
    """Replace-on-same-id: the row with the greatest version per id (K3-K5).

    A rank filtered to its first row: Spark keeps one row an id in every task
    before the shuffle, so an id with very many versions is no hot group, and
    payloads are not sorted in aggregation buffers. Equal versions are told
    apart by a hash of the other columns, so a recomputation takes the same.
    """
    others = [F.col(f"`{f.name}`") for f in df.schema.fields if f.name not in (*id_cols, *version_cols) and "map<" not in f.dataType.simpleString()]
    order = [*[F.col(c).desc_nulls_last() for c in version_cols], F.xxhash64(*others) if others else F.lit(0)]
    nth = F.row_number().over(Window.partitionBy(*id_cols).orderBy(*order))
    return df.withColumn("_nth", nth).where("_nth = 1").drop("_nth")


def upsert(existing: DataFrame, updates: DataFrame, id_cols: Sequence[str], version_col: str = "_version") -> DataFrame:
    """Union old and new documents and keep the newest per id (K3-K5).

    Rows without a version column get 0 for ``existing`` and 1 for
    ``updates``, so new documents replace old ones with the same id.
    """
    old = existing if version_col in existing.columns else existing.withColumn(version_col, F.lit(0))
    new = updates if version_col in updates.columns else updates.withColumn(version_col, F.lit(1))
    return latest_version(old.unionByName(new, allowMissingColumns=True), id_cols, [version_col]).drop(version_col)


def upsert_samples(existing: DataFrame, updates: DataFrame, id_cols: Sequence[str] = ("sample",)) -> DataFrame:
    """Sample documents redacted below their depth, then upserted (K5)."""
    return upsert(existing, redact_sample_document(updates), id_cols)


def upsert_features(existing: DataFrame, updates: DataFrame, sets_col: str = "feature_sets", id_cols: Sequence[str] = ("sample", "uuid", "run_id")) -> DataFrame:
    """Feature documents upserted; those whose set map is empty are skipped (K4)."""
    return upsert(existing, updates.where(F.size(sets_col) > 0), id_cols)


def upload_doc_id(df: DataFrame) -> DataFrame:
    """Add the upload/feature document id ``sample-uuid-run_id`` (K3, K4)."""
    return df.withColumn("id", F.concat_ws("-", F.col("sample").cast("string"), F.col("uuid"), F.col("run_id").cast("string")))


def skip_existing(todo: DataFrame, done: DataFrame, keys: Sequence[str], force: bool = False) -> DataFrame:
    """Rows of ``todo`` whose output does not exist yet, unless ``force``."""
    if force:
        return todo
    return todo.join(done.select(*keys).distinct(), on=list(keys), how="left_anti")


def write_features(features: DataFrame, path: str, batch: str | None = None) -> None:
    """Feature table as Parquet partitioned by family, version and batch (K1).

    A write replaces nothing but its own batch, so other uploads' features
    stay. The batch is a digest of the (sample, uuid, run_id) it holds unless
    named, so a job that runs again rewrites its own partition. Where batches
    overlap, :func:`read_feature_table` takes an upload's newest.
    """
    keys = ["sample", "uuid", "run_id"]
    out = features
    if "feature_set_name" not in out.columns:
        out = out.withColumn("feature_set_name", F.lit(FEATURE_FAMILY))
    if "feature_set_ver" not in out.columns:
        out = out.withColumn("feature_set_ver", F.lit(FEATURE_VERSION))
    if batch is None:
        mark = features.select(*keys).distinct().agg(F.sum(F.xxhash64(*keys).cast("decimal(20,0)")), F.count(F.lit(1))).first()
        batch = f"{mark[0]}_{mark[1]}".replace("-", "m")
    (
        out.withColumn("batch", F.lit(batch))
        .withColumn("written_us", F.unix_micros(F.current_timestamp()))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("feature_set_name", "feature_set_ver", "batch")
        .parquet(path)
    )


def read_feature_table(spark: SparkSession, path: str) -> DataFrame:
    """What :func:`write_features` wrote: of each upload, family and version the newest batch."""
    table = spark.read.parquet(path)
    keys = ["sample", "uuid", "run_id", "feature_set_name", "feature_set_ver"]
    newest = table.groupBy(*keys).agg(F.max(F.struct("written_us", "batch")).alias("_at"))
    newest = newest.select(*keys, F.col("_at.written_us").alias("written_us"), F.col("_at.batch").alias("batch"))
    return table.join(newest, [*keys, "written_us", "batch"], "left_semi").drop("written_us", "batch")


def feature_documents(features: DataFrame, meta: DataFrame | None = None) -> DataFrame:
    """One JSON document per (sample, uuid, run_id, set name, version) (K1 export).

    ``feature_sets`` maps feature name -> {feature_data, feature_metadata}.  A
    document holds at most the 36 grid features, so the map is bounded.
    """
    keys = ["sample", "uuid", "run_id"]
    fs = F.struct(
        F.col("feature_data"),
        F.array(
            F.struct(
                F.col("histogram_max").cast("long").alias("histogram_max"),
                F.col("histogram_mean").cast("long").alias("histogram_mean"),
                F.col("histogram_min").cast("long").alias("histogram_min"),
                F.col("histogram_std_dev").cast("long").alias("histogram_std_dev"),
            )
        ).alias("feature_metadata"),
    )
    docs = features.groupBy(*keys).agg(F.map_from_entries(F.collect_list(F.struct("feature", fs))).alias("feature_sets"))
    docs = docs.select(
        F.col("sample").cast("string").alias("sample_id"),
        F.col("run_id").cast("string").alias("run_id"),
        F.lit(FEATURE_FAMILY).alias("feature_set_name"),
        F.lit(FEATURE_VERSION).alias("feature_set_ver"),
        "uuid",
        "feature_sets",
    )
    if meta is not None:
        docs = docs.join(meta, on=["sample_id", "uuid", "run_id"], how="left")
    return docs


def to_json_documents(docs: DataFrame) -> DataFrame:
    """Render documents as JSON text (one ``value`` column), sorted map keys."""
    cols = sorted(docs.columns)
    sorted_docs = docs.select(*[
        F.map_from_entries(F.array_sort(F.map_entries(F.col(c)))).alias(c)
        if c == "feature_sets" else F.col(f"`{c}`")
        for c in cols
    ])
    return sorted_docs.select(F.to_json(F.struct(*[F.col(f"`{c}`") for c in cols])).alias("value"))


def write_json_documents(docs: DataFrame, path: str) -> None:
    """JSON text sink."""
    to_json_documents(docs).write.mode("overwrite").text(path)


def write_feature_documents(docs: DataFrame, path: str) -> None:
    """Feature documents as a JSON file each, in a folder a sample, upload and run, which ``read_features`` reads (K1).

    The folders are ``s=<sample>/u=<uuid>/r=<run_id>``; Spark names the files.
    """
    keyed = docs.select("*", F.col("sample_id").alias("s"), F.col("uuid").alias("u"), F.col("run_id").alias("r"))
    keyed.repartition("s", "u", "r").write.mode("overwrite").partitionBy("s", "u", "r").json(path)


#: Ids in one file of a sample set, about, and in a set's JSON document, at most.
SET_FILE_ROWS, SET_DOCUMENT_ROWS = 250_000, 1_000_000


def write_sample_set_rows(sample_set: DataFrame, path: str) -> None:
    """Sample sets ``(name, sample, label)`` as rows, partitioned by name and label, with a manifest of their sizes (K6).

    A member goes to one of as many files as its (name, label) fills, by a
    hash of its id; no task holds a set.
    """
    root = path.rstrip("/")
    sizes = sample_set.groupBy("name", "label").agg(F.count(F.lit(1)).alias("n"))
    sizes.write.mode("overwrite").parquet(f"{root}/manifest")
    files = sample_set.sparkSession.read.parquet(f"{root}/manifest").select("name", "label", F.ceil(F.col("n") / F.lit(SET_FILE_ROWS)).alias("_files"))
    # One row a (name, label): a small side, which Spark broadcasts by its measured size.
    dealt = sample_set.join(files, ["name", "label"]).withColumn("_file", F.pmod(F.xxhash64("sample"), F.col("_files")))
    dealt.repartition("name", "label", "_file").drop("_files", "_file").write.mode("overwrite").partitionBy("name", "label").parquet(f"{root}/rows")


def export_sample_set(sample_set: DataFrame, path: str, tags: Sequence[str] = (), most: int = SET_DOCUMENT_ROWS) -> None:
    """Each set as one JSON document ``{name, tags, data: {benign, malware}}`` (K6), for sets of at most ``most`` ids.

    The document is a single value, which one task has to hold: larger sets
    are refused and stay rows.
    """
    largest = sample_set.groupBy("name").agg(F.count(F.lit(1)).alias("n")).agg(F.max("n")).first()[0] or 0
    if largest > most:
        raise ValueError(f"a sample set of {largest} ids is too large for one document: keep it as rows")
    write_sample_set(sample_set_document(sample_set, list(tags)), path)


def write_sample_set(doc: DataFrame, path: str) -> None:
    """Sample set documents ``{name, tags, data: {benign, malware}}``, a line each (K6)."""
    doc.write.mode("overwrite").json(path)


def write_metrics_csv(metrics: DataFrame, path: str, label_cols: Sequence[str] = ("feature", "classifier", "normaliser")) -> None:
    """Metrics table: one label column, the report's header, a row per label (K7)."""
    metrics_csv(metrics, label_cols).write.mode("overwrite").option("header", True).csv(path)


def save_model(model, path: str) -> None:
    """Persist a fitted pipeline: scaler and classifier together (K8)."""
    model.write().overwrite().save(path)


def rebuild_tables(tables: dict[str, DataFrame], root: str) -> None:
    """Full reload of the samples, uploads and features tables (K9)."""
    for name, df in tables.items():
        df.write.mode("overwrite").parquet(f"{root.rstrip('/')}/{name}")


#: Folders that named files are dealt out to, by a hash of the name: no folder has to be listed as a whole by one process.
NAMED_FOLDERS = 256


def arrow_file_system(path: str):
    """The Arrow file system of a path, and the path in it; None where Arrow knows no such scheme."""
    from pyarrow import fs

    if "://" in path and path.split("://", 1)[0] not in ("file", "hdfs", "s3", "gs", "abfs", "abfss"):
        return None
    return fs.FileSystem.from_uri(path if ":" in path.split("/", 1)[0] else f"file://{path}")


def _write_files(files: DataFrame, path: str, place: Callable[[str], tuple[str, str]]) -> int:
    """Rows (file, content) as a file each, in the folder under ``path`` and by the name that ``place`` gives; their number.

    Each task writes its rows through the Arrow file system of the path, to a
    hidden name first and then renamed, so a task that runs again leaves no
    half file.
    """
    from pyspark.errors import PySparkValueError

    if "://" in path and not path.startswith("file:"):
        scheme = path.split("://", 1)[0]
        if scheme not in ("hdfs", "s3", "gs", "abfs", "abfss"):
            raise PySparkValueError(f"no named files on {scheme}")

    def run(batches):
        import pyarrow as pa

        system, root = arrow_file_system(path)
        system.create_dir(root, recursive=True)
        made = set()
        for batch in batches:
            for file, content in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                folder, name = place(str(file))
                if folder not in made:
                    system.create_dir(f"{root}/{folder}", recursive=True)
                    if len(made) < NAMED_FOLDERS:
                        made.add(folder)
                hidden = f"{root}/{folder}/.{name}-{uuid.uuid4().hex[:8]}"
                with system.open_output_stream(hidden) as out:
                    out.write(content)
                system.move(hidden, f"{root}/{folder}/{name}")
            yield pa.RecordBatch.from_pydict({"n": pa.array([batch.num_rows], pa.int64())})

    done = files.select("file", F.col("content").cast("binary").alias("content")).mapInArrow(run, "n long")
    return done.agg(F.sum("n")).collect()[0][0] or 0


def write_named_files(files: DataFrame, path: str) -> None:
    """Rows (file, content) as a file each, under their own names, in NAMED_FOLDERS folders by a hash of the name.

    For samples and documents, which other tools know by their names.
    """

    def place(name: str) -> tuple[str, str]:
        import zlib

        return f"{zlib.crc32(name.encode()) % NAMED_FOLDERS:02x}", name

    _write_files(files, path, place)


def write_upload_documents(uploads: DataFrame, root: str) -> int:
    """Uploads as a JSON document each, ``<root>/sample=<s>/uuid=<u>/run_id=<r>/part-*.json``, beside those that are there; their number.

    ``read_uploads`` reads them. All tasks write, however few files the uploads come from.
    """
    from .readers import tasks

    spark = uploads.sparkSession
    others = [F.col(f"`{c}`") for c in uploads.columns if c not in TRACE_KEYS]
    folders = [
        F.concat(F.lit(f"{k}="), F.coalesce(F.replace(F.url_encode(F.col(k).cast("string")), F.lit("+"), F.lit("%20")), F.lit("__HIVE_DEFAULT_PARTITION__")))
        for k in TRACE_KEYS
    ]
    documents = uploads.select(F.concat_ws("/", *folders).alias("folder"), F.to_json(F.struct(*others)).alias("content"))
    # In order, so that a task that runs again gives its documents the same names.
    dealt = documents.repartition(tasks(spark), "folder").sortWithinPartitions("folder", "content")
    name = F.format_string(f"%s/part-%d-{uuid.uuid4().hex[:8]}.json", F.col("folder"), F.monotonically_increasing_id())
    system, path = arrow_file_system(root) or (None, None)
    if system is not None:
        system.create_dir(path, recursive=True)  # also if there is no upload

    def place(file: str) -> tuple[str, str]:
        folder, _, last = file.rpartition("/")
        return folder, last

    return _write_files(dealt.select(name.alias("file"), "content"), root, place)


def metadata_document(df: DataFrame, version: str = "0.0.1", version_key: str = METADATA_VERSION_KEY) -> DataFrame:
    """Sample metadata JSON; optional vti / label / existing only when present."""
    cols = [F.col("source"), F.col("arch"), F.lit(version).alias(version_key)]
    for opt in ("label", "vti", "existing"):
        if opt in df.columns:
            cols.append(F.col(opt))
    return df.select("sample", F.to_json(F.struct(*cols), {"ignoreNullFields": "true"}).alias("value"))


#: Folders of an ingested trace table; a trace is in the one that its keys hash to.
TRACE_BUCKETS = 64
TRACE_KEYS = ("sample", "uuid", "run_id")


def _trace_bucket():
    return F.pmod(F.xxhash64(*[F.col(k).cast("string") for k in TRACE_KEYS]), F.lit(TRACE_BUCKETS)).cast("int")


def ingest_traces(spark, paths, out: str, on_error: str = "raise") -> None:
    """Parse tracer text once into the canonical trace table (S1 -> Parquet).

    Rows ``(sample, uuid, run_id, seq, ins, rw, tgt)`` with ``seq`` the line
    number in the file, clustered by trace and line inside each output file
    (a local sort, no shuffle), so later chunking reads Parquet with column
    pruning instead of re-reading text (gz files are one split each). The
    table is partitioned by a hash of the trace's keys, so that
    :func:`read_traces` opens the folders of the uploads at hand alone.
    """
    from .readers import read_trace

    tr = read_trace(spark, paths, on_error=on_error, dense_seq=True).withColumn("bucket", _trace_bucket())
    (
        tr.sortWithinPartitions("bucket", *TRACE_KEYS, "seq")
        .write.mode("overwrite")
        .option("compression", "zstd")
        .partitionBy("bucket")
        .parquet(out)
    )


def read_traces(spark: SparkSession, path: str, uploads: DataFrame | None = None) -> DataFrame:
    """The ingested traces, or those of the given uploads: their folders are chosen before the scan, then their keys."""
    table = spark.read.parquet(path)
    if uploads is None:
        return table.drop("bucket")
    wanted = uploads.select(*TRACE_KEYS).distinct()
    buckets = [r[0] for r in wanted.select(_trace_bucket()).distinct().collect()]  # at most TRACE_BUCKETS
    return table.where(F.col("bucket").isin(buckets)).drop("bucket").join(wanted, list(TRACE_KEYS), "left_semi")

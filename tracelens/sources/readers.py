"""Sources (S1-S11): traces, uploads, metadata, binaries, features, sample sets.

Every reader declares its schema (no inference) and returns a DataFrame;
searches are plain filters Catalyst pushes into the scan.
"""

from __future__ import annotations

import fnmatch
import re
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import catalog as CF
from ..functions import trace as TF
from ..streaming.runs import qualified

#: Bytes of file contents in a batch, about.
READ_BYTES = 8 << 20

# -- schemas ----------------------------------------------------------------

SCAN_MAP = T.MapType(T.StringType(), T.StructType([T.StructField("detected", T.BooleanType())]))
REPORT = T.StructType([T.StructField("scans", SCAN_MAP), T.StructField("additional_info", T.StringType())])


def sample_metadata_schema(version_key: str = CF.METADATA_VERSION_KEY) -> T.StructType:
    """Fields of a sample metadata document whose importer version stands under ``version_key``."""
    text = [T.StructField(n, T.StringType()) for n in ("source", "arch", "label", version_key)]
    return T.StructType([*text, T.StructField("vti", REPORT), T.StructField("existing", REPORT)])



UPLOAD_METADATA = T.StructType(
    [
        T.StructField(n, T.StringType())
        for n in (
            "node", "uuid", "run_id", "extractor-pack", "status", "status_msg", "runs-left", "manifest",
            "output_before_gz", "output_after_gz", "exec_start_tm", "exec_end_tm",
        )
    ]
)
FEATURE_SET = T.StructType(
    [
        T.StructField("feature_data", T.ArrayType(T.LongType())),
        T.StructField(
            "feature_metadata",
            T.ArrayType(
                T.StructType(
                    [
                        T.StructField("histogram_min", T.LongType()),
                        T.StructField("histogram_max", T.LongType()),
                        T.StructField("histogram_mean", T.LongType()),
                        T.StructField("histogram_std_dev", T.LongType()),
                    ]
                )
            ),
        ),
    ]
)
FEATURE_DOC = T.StructType(
    [
        T.StructField("sample_id", T.StringType()),
        T.StructField("run_id", T.StringType()),
        T.StructField("feature_set_name", T.StringType()),
        T.StructField("feature_set_ver", T.StringType()),
        T.StructField("node", T.StringType()),
        T.StructField("extractor-pack", T.StringType()),
        T.StructField("uuid", T.StringType()),
        T.StructField("feature_sets", T.MapType(T.StringType(), FEATURE_SET)),
    ]
)
SAMPLE_SET = T.StructType(
    [
        T.StructField("name", T.StringType()),
        T.StructField("tags", T.ArrayType(T.StringType())),
        T.StructField(
            "data",
            T.StructType(
                [T.StructField("benign", T.ArrayType(T.StringType())), T.StructField("malware", T.ArrayType(T.StringType()))]
            ),
        ),
    ]
)

# Upload layout: <root>/<sample>/<uuid>/<run_id>/<file> (plain or key=value directories)
_UPLOAD_PATH = r"/(?:sample=)?([^/=]+)/(?:uuid=)?([^/=]+)/(?:run_id=)?([0-9]+)/[^/]+$"


# -- S1: traces ---------------------------------------------------------------

def parse_trace(lines: DataFrame, line_col: str = "value", keep: Sequence[str] = (), on_error: str = "raise") -> DataFrame:
    """Parse tracer lines into ``keep + [ins, rw, tgt]`` (F1, F2).

    ``ins`` is the exact unsigned instruction address (DECIMAL(20,0)); ``tgt``
    the target as a 64-bit word (LONG, see ``functions.trace.hex_to_word``).
    Non-matching lines (including 16/32-byte accesses) are dropped.  A
    matching field that is not hex fails the query (``on_error='raise'``, as
    the reference does) or drops the line (``'drop'``).
    """
    p = TF.parse_trace_line(F.col(line_col))
    mode = "raise" if on_error == "raise" else "null"
    out = lines.select(*keep, *[v.alias(k) for k, v in p.items()]).where(F.col("rw") != "")
    out = out.select(
        *keep,
        TF.hex_to_int(F.col("ins_hex"), mode).alias("ins"),
        "rw",
        TF.hex_to_word(F.col("tgt_hex"), mode).alias("tgt"),
    )
    if on_error != "raise":
        out = out.where(F.col("ins").isNotNull() & F.col("tgt").isNotNull())
    return out


def read_trace_lines(spark: SparkSession, paths: str | Sequence[str], dense_seq: bool = True) -> DataFrame:
    """Trace text files (plain or .gz by suffix) as lines with their order.

    Comment lines are dropped and lines right-stripped.  In the same
    projection as the scan we take the file split start (``split_start``) and
    the per-partition row counter (``split_row``): inside one file,
    ``(split_start, split_row)`` is the line order.

    * ``dense_seq=False`` returns ``(path, split_start, split_row, value)``
      from a single scan; rank with ``order_cols=("split_start",
      "split_row")`` and ``bucket_rows=1`` (a bucket per 2^20 lines of a split,
      so that a gz file, which is one split, is no single group).
    * ``dense_seq=True`` (default) adds ``seq``, the 0-based line number in
      the file, from a per-split line count (one row per split) - a second,
      cheap pass over the text.

    gz files are not splittable; write the result to Parquet once.
    """
    raw = spark.read.text(paths if isinstance(paths, str) else list(paths))
    base = raw.select(
        F.col("_metadata.file_path").alias("path"),
        F.col("_metadata.file_block_start").alias("split_start"),
        (F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))).alias("split_row"),
        "value",
    )
    if not dense_seq:
        return base.select("path", "split_start", "split_row", F.rtrim("value").alias("value")).where(
            ~F.col("value").startswith("#")
        )
    splits = base.groupBy("path", "split_start").agg(
        F.min("split_row").alias("_lo0"), F.count(F.lit(1)).alias("_n")
    )
    before = Window.partitionBy("path").orderBy("split_start").rowsBetween(Window.unboundedPreceding, -1)
    offsets = splits.select(
        "path", "split_start", "_lo0", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_off")
    )
    lines = base.join(offsets, on=["path", "split_start"], how="inner").select(
        "path", (F.col("_off") + F.col("split_row") - F.col("_lo0")).alias("seq"), F.rtrim("value").alias("value")
    )
    return lines.where(~F.col("value").startswith("#"))


def read_trace(spark: SparkSession, paths: str | Sequence[str], on_error: str = "raise", dense_seq: bool = True) -> DataFrame:
    """Trace rows ``(sample, uuid, run_id, seq | split_start+split_row, ins, rw, tgt)``.

    Keys come from the path ``.../<sample>/<uuid>/<run_id>/<file>``; see
    :func:`read_trace_lines` for the two order forms.
    """
    lines = read_trace_lines(spark, paths, dense_seq)
    order = ["seq"] if dense_seq else ["split_start", "split_row"]
    keyed = lines.select(
        F.regexp_extract("path", _UPLOAD_PATH, 1).alias("sample"),
        F.regexp_extract("path", _UPLOAD_PATH, 2).alias("uuid"),
        F.regexp_extract("path", _UPLOAD_PATH, 3).cast("int").alias("run_id"),
        *order,
        "value",
    )
    return parse_trace(keyed, keep=["sample", "uuid", "run_id", *order], on_error=on_error)


# -- S2, S3, S5, S6: JSON documents -----------------------------------------

def tasks(spark: SparkSession) -> int:
    """Tasks to deal work on single files out to."""
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)


#: For a stream of many small files: no cache of files listed, which only keeps them on the driver's heap, and no block's hosts with each file.
LEAN_LISTING = {"spark.sql.hive.filesourcePartitionFileCacheSize": "0", "spark.sql.sources.ignoreDataLocality": "true"}


def _listing_session(spark: SparkSession) -> SparkSession:
    """A session with the settings of this one, which lists files in as many tasks as run at once and holds little of each.

    Spark's default is a task a path, up to 10,000, for each of a file stream's
    listings. What the session sets itself stays.
    """
    given, own = dict(spark.conf.getAll), spark.newSession()
    for name, value in given.items():
        if own.conf.isModifiable(name):
            own.conf.set(name, value)
    for name, value in {"spark.sql.sources.parallelPartitionDiscovery.parallelism": str(tasks(spark)), **LEAN_LISTING}.items():
        if name not in given:
            own.conf.set(name, value)
    return own


def read_uploads(
    spark: SparkSession,
    root: str,
    meta_glob: str = "*/*/*/run-*-meta.json",
    stream: bool = False,
    max_files_per_trigger: int | None = None,
) -> DataFrame:
    """Upload metadata of every ``<sample>/<uuid>/<run_id>`` tree.

    Unreadable documents are skipped (DROPMALFORMED); a single unreadable
    field is null, and its document stays.  Keys come from the
    path (plain or ``key=value`` directories); the real run id is used (D3).
    With ``stream`` the same documents are read as a file stream (W1 source):
    each new metadata file is one new upload. The trees are then listed by
    tasks, from the root: Spark resolves a glob folder by folder on the driver.
    """
    path = F.col("_metadata.file_path")
    if stream:
        reader = _listing_session(spark).readStream.schema(UPLOAD_METADATA)
        if max_files_per_trigger:
            reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    else:
        reader = spark.read.schema(UPLOAD_METADATA)
    reader = reader.option("mode", "DROPMALFORMED").option("multiLine", True)
    folders, _, name = meta_glob.rpartition("/")
    if stream and folders == "*/*/*" and not re.search(r"[*?\[{]", root):
        raw = reader.option("recursiveFileLookup", "true").option("pathGlobFilter", name).json(root)
        # The scheme taken off, a document is three folders below the root.
        below = F.size(F.split(F.regexp_replace(path, r"^[A-Za-z][A-Za-z0-9+.-]*:(//[^/]*)?", ""), "/"))
        raw = raw.where(below == len(qualified(spark, root).rstrip("/").split("/")) + 4)
    else:
        raw = reader.json(f"{root.rstrip('/')}/{meta_glob}")
    return raw.select(
        F.regexp_extract(path, _UPLOAD_PATH, 1).alias("sample"),
        F.regexp_extract(path, _UPLOAD_PATH, 2).alias("uuid"),
        F.regexp_extract(path, _UPLOAD_PATH, 3).try_cast("int").alias("run_id"),
        "node",
        F.col("`extractor-pack`").alias("extractor_pack"),
        "status",
        "status_msg",
        F.col("`runs-left`").try_cast("int").alias("runs_left"),
        "manifest",
        F.col("output_before_gz").try_cast("long").alias("output_before_gz"),
        F.col("output_after_gz").try_cast("long").alias("output_after_gz"),
        CF.parse_ts(F.col("exec_start_tm")).alias("exec_start_tm"),
        CF.parse_ts(F.col("exec_end_tm")).alias("exec_end_tm"),
    )


def read_named_files(spark: SparkSession, path: str, pattern: str) -> DataFrame:
    """(file, length, content) of the files in ``path`` whose names match the regular expression ``pattern``.

    The files lie in the folder itself or in the folders that
    ``write_named_files`` deals them out to; a glob may stand for the last part
    of the path. Tasks list and read the folders, so the driver holds no file
    names. Of a store that Arrow does not know, Spark's reader lists the folder.

    Spark knows the size of the list of folders, not of the files in them, and
    would broadcast the files through the driver at a join: the hint has it
    shuffle them.
    """
    from .sinks import arrow_file_system

    folder, _, last = path.rstrip("/").rpartition("/")
    at, glob = (folder, last) if re.search(r"[*?\[{]", last) else (path.rstrip("/"), None)
    if arrow_file_system(at) is None or re.search(r"[*?\[{]", at) or (glob and "{" in glob):
        raw = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
        return raw.select(F.col("_metadata.file_name").alias("file"), "length", "content").where(F.col("file").rlike(pattern))

    def named(info) -> bool:
        return info.is_file and re.search(pattern, info.base_name) is not None

    def top(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Files and folders of the path itself."""
        for batch in batches:
            for given in batch.column(0).to_pylist():
                system, root = arrow_file_system(given)
                found = system.get_file_info(root)
                entries = [found] if found.is_file else system.get_file_info(fs.FileSelector(root))
                if glob:
                    keep = [e for e in entries if fnmatch.fnmatchcase(e.base_name, glob) and e.base_name[0] not in "._" and (named(e) or not e.is_file)]
                else:
                    keep = [e for e in entries if named(e) or (not e.is_file and re.fullmatch("[0-9a-f]{2,}", e.base_name))]
                for start in range(0, len(keep), 10_000):
                    part = keep[start : start + 10_000]
                    yield pa.RecordBatch.from_pydict({"entry": [e.path for e in part]})

    def contents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, _ = arrow_file_system(at)
        held: list[tuple[str, bytes]] = []
        size = 0
        for batch in batches:
            for entry in batch.column(0).to_pylist():
                found = system.get_file_info(entry)
                for info in [found] if found.is_file else system.get_file_info(fs.FileSelector(entry)):
                    if not named(info):
                        continue
                    with system.open_input_stream(info.path, compression=None) as data:
                        held.append((info.base_name, data.read()))
                    size += len(held[-1][1]) + 256
                    if size >= READ_BYTES:
                        yield packed(held)
                        held, size = [], 0
        if held:
            yield packed(held)

    def packed(held: list[tuple[str, bytes]]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([n for n, _ in held]), pa.array([len(c) for _, c in held], pa.int64()), pa.array([c for _, c in held], pa.binary())], names=["file", "length", "content"])

    entries = spark.createDataFrame([(at,)], "entry string").coalesce(1).mapInArrow(top, "entry string")
    return entries.repartition(tasks(spark), "entry").mapInArrow(contents, "file string, length long, content binary").hint("merge")


def read_sample_metadata(spark: SparkSession, samples_dir: str, version_key: str = CF.METADATA_VERSION_KEY) -> DataFrame:
    """``<sha>.json`` sample metadata documents (S3); sample id from the name."""
    schema = sample_metadata_schema(version_key)
    raw = read_named_files(spark, samples_dir, CF.SHA256_META_NAME).where((F.col("length") > 0) & F.col("file").endswith(".json"))
    name = F.regexp_extract("file", r"^(.*)\.json$", 1)
    # A document is an object or an array of them; one that does not parse is a row of nulls.
    parsed = raw.select(name.alias("sample"), F.from_json(F.col("content").cast("string"), T.ArrayType(schema)).alias("m"))
    each = parsed.where(F.coalesce(F.size("m"), F.lit(-1)) != 0).select("sample", F.explode_outer("m").alias("m"))
    return each.select("sample", *[F.col("m").getField(n).alias(n) for n in schema.names])


def read_sidecar_reports(spark: SparkSession, input_dir: str) -> DataFrame:
    """Scan reports shipped next to imported files as ``<file>.json`` (J9 input).

    Returns ``(path, existing)`` where ``path`` is the imported file's path.
    """
    raw = spark.read.schema(REPORT).option("multiLine", True).json(f"{input_dir.rstrip('/')}/*.json")
    return raw.select(
        F.regexp_replace(F.col("_metadata.file_path"), r"\.json$", "").alias("path"),
        F.struct("scans", "additional_info").alias("existing"),
    )


def read_samples(spark: SparkSession, samples_dir: str, verify: bool = True) -> DataFrame:
    """Binary samples ``(sample, length, content)`` (S4): only 64-character
    names; with ``verify`` the content hash must equal the name."""
    out = read_named_files(spark, samples_dir, CF.SHA256_NAME).select(F.col("file").alias("sample"), "length", "content")
    if verify:
        out = out.where(F.sha2(F.col("content"), 256) == F.lower(F.col("sample")))
    return out


def read_binaries(spark: SparkSession, input_dir: str) -> DataFrame:
    """Files to import, named by the SHA-256 of their content (S4, import side)."""
    raw = spark.read.format("binaryFile").load(input_dir)
    return raw.select(F.sha2("content", 256).alias("sample"), "path", "length", "content")


def read_features(
    spark: SparkSession, features_dir: str, run_id: str = "*", file_name: str = "ext-mem-rw-dump-0.0.1.json", pattern: str | None = None
) -> DataFrame:
    """Feature documents exploded to one row per feature set.

    ``pattern`` is the glob below ``features_dir``, by default
    ``<sample>/<run_id>/<file_name>``; ``s=*/u=*/r=*/*.json`` reads what
    ``write_feature_documents`` wrote. Hidden sample directories are skipped; documents with an empty
    ``feature_sets`` contribute no row.
    """
    raw = spark.read.schema(FEATURE_DOC).option("multiLine", True).json(
        f"{features_dir.rstrip('/')}/{pattern or f'[!.]*/{run_id}/{file_name}'}"
    )
    return raw.where(F.size("feature_sets") > 0).select(
        F.col("sample_id").alias("sample"),
        "uuid",
        "run_id",
        "feature_set_name",
        "feature_set_ver",
        F.explode("feature_sets").alias("feature", "fs"),
    ).select(
        "sample", "uuid", "run_id", "feature_set_name", "feature_set_ver", "feature",
        F.col("fs.feature_data").alias("feature_data"),
        F.col("fs.feature_metadata").getItem(0).alias("feature_metadata"),
    )


def read_sample_set_rows(spark: SparkSession, path: str, name: str | None = None) -> DataFrame:
    """``(name, sample, label)`` of a set kept as rows (:func:`.sinks.write_sample_set_rows`); one set's folders only, if named."""
    rows = spark.read.parquet(f"{path.rstrip('/')}/rows").select("name", "sample", "label")
    return rows if name is None else rows.where(F.col("name") == name)


def read_sample_set(spark: SparkSession, path: str) -> DataFrame:
    """Sample set JSON -> ``(name, sample, label)`` rows."""
    raw = spark.read.schema(SAMPLE_SET).json(path)
    ben = raw.select("name", F.explode("data.benign").alias("sample"), F.lit(0.0).alias("label"))
    mal = raw.select("name", F.explode("data.malware").alias("sample"), F.lit(1.0).alias("label"))
    return ben.unionByName(mal)


# -- S7-S11: searches ----------------------------------------------------------

def _conj(df: DataFrame, **eq) -> DataFrame:
    for col, val in eq.items():
        if val is not None:
            df = df.where(F.col(col) == F.lit(val))
    return df


def search_uploads(uploads: DataFrame, extractor_pack: str | None = None, feature_family: str | None = None, sample: str | None = None) -> DataFrame:
    """Conjunction of the given filters (S7); ``feature_family`` matches the
    families the upload's pack produces (one canonical pack column, D11)."""
    out = _conj(uploads, extractor_pack=extractor_pack, sample=sample)
    if feature_family is not None:
        packs = [p for p, fams in CF.PACK_FAMILIES.items() if feature_family in fams]
        out = out.where(F.col("extractor_pack").isin(packs))
    return out


def search_samples(samples: DataFrame, label: str | None = None, arch: str | None = None, source: str | None = None, sample: str | None = None) -> DataFrame:
    """Samples matching every given field exactly."""
    return _conj(samples, label=label, arch=arch, source=source, sample=sample)


def search_features(features: DataFrame, sample: str | None = None) -> DataFrame:
    """Feature rows of one sample, or all."""
    return _conj(features, sample=sample)


def get_by_id(df: DataFrame, key: str, value) -> DataFrame:
    """Point lookup (S10); for many ids join instead."""
    return df.where(F.col(key) == F.lit(value))


def fetch_all(df: DataFrame) -> DataFrame:
    """The whole result, never one page of it."""
    return df

"""Catalogue, upload and identifier scalar functions.

All native expressions; none needs a Python UDF.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values from the reference: name patterns, run timeout, statuses.
SHA256_NAME = r"^[A-Za-z0-9]{64}$"
SHA256_META_NAME = r"^[A-Za-z0-9]{64}.json$"
RUN_TIMEOUT_SECONDS = 3 * 60
STATUS_OK, STATUS_ERR, STATUS_WARN = "OK", "ERR", "WARN"
NO_FILE_MSG = "no_file_to_upload"
WATCHDOG_TIMEOUT_MSG = "vm watchdog timeout"
# Key of the importer version field in sample metadata documents; documents
# written elsewhere may name it otherwise, which readers and writers take as a parameter.
METADATA_VERSION_KEY = "importer-version"
# Extractor pack -> feature families, and extractor pack -> extractors (fixed lookups of the reference).
PACK_FAMILIES = {"pack-1": ["mem_rw_dump"]}
PACK_EXTRACTORS = {"pack-1": ["ext-mem-rw-dump"]}


def is_sha256_name(name: Column) -> Column:
    """Catalogue names: 64 letters/digits (F4). Not hex-only, as in the reference."""
    return name.rlike(SHA256_NAME)


def is_sha256_meta_name(name: Column) -> Column:
    """Metadata file names ``<64 chars><any char>json`` (the dot is unescaped)."""
    return name.rlike(SHA256_META_NAME)


def valid_pe(file_type: Column) -> Column:
    """File type starts with ``PE32`` and is not a DLL."""
    return file_type.startswith("PE32") & ~file_type.contains("(DLL)")


def arch_of(file_type: Column) -> Column:
    """'64' for PE32+, '32' for other PE, else null."""
    return F.when(file_type.contains("PE32+"), F.lit("64")).when(file_type.contains("PE"), F.lit("32"))


def run_ok(status: Column) -> Column:
    """A run counts as successful when it has a status other than ERR."""
    return status.isNotNull() & (status != STATUS_ERR)


def parse_ts(text: Column) -> Column:
    """``yyyy-MM-dd HH:mm:ss`` with an optional fraction (F10), as a
    time-zone-free TIMESTAMP_NTZ (the text carries no zone); null for other texts."""
    return F.when(text.rlike(r"^[0-9]{4}-[0-9]{2}-[0-9]{2} [0-9]{2}:[0-9]{2}:[0-9]{2}(\.[0-9]+)?$"), text.try_cast("timestamp_ntz"))


def epoch_us(ts: Column) -> Column:
    """Microseconds since 1970-01-01 of a TIMESTAMP_NTZ, independent of the session time zone."""
    return F.timestamp_diff("MICROSECOND", F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"), ts.cast("timestamp_ntz"))


def run_duration_seconds(start: Column, end: Column) -> Column:
    """End minus start in seconds, with microseconds (F11); whole days kept."""
    return (epoch_us(end) - epoch_us(start)) / F.lit(1_000_000.0)


def compression_ratio(before: Column, after: Column) -> Column:
    """Output size after gzip over size before (F12); null when before is 0 or missing."""
    return F.try_divide(after.cast("double"), before.cast("double"))


def runs_left(total_runs: Column, run_id: Column) -> Column:
    """Runs still to do after this one."""
    return total_runs.cast("int") - run_id.cast("int") - F.lit(1)


def strip_exe(name: Column) -> Column:
    """Drop an ``.exe`` suffix from an uploaded name (F16)."""
    return F.regexp_replace(name, r"\.exe$", "")


def status_of_run(output_size: Column, duration_s: Column) -> dict[str, Column]:
    """Status and message of a run (F17): timed out -> WARN (kept, see D9),
    output present -> OK, no output -> ERR ``no_file_to_upload``."""
    timed_out = duration_s >= F.lit(RUN_TIMEOUT_SECONDS)
    status = F.when(timed_out, F.lit(STATUS_WARN)).when(output_size.isNotNull(), F.lit(STATUS_OK)).otherwise(
        F.lit(STATUS_ERR)
    )
    msg = F.when(timed_out, F.lit(f"breached agent timeout ({RUN_TIMEOUT_SECONDS // 60}m)")).when(
        output_size.isNotNull(), F.lit("uploading")
    ).otherwise(F.lit(NO_FILE_MSG))
    return {"status": status, "status_msg": msg}


def doc_id(*parts: Column) -> Column:
    """``sample-uuid-run`` document id."""
    return F.concat_ws("-", *[p.cast("string") for p in parts])


def sample_of_doc_id(doc: Column) -> Column:
    """The sample part of a document id: text before the first '-' (F18)."""
    return F.split_part(doc, F.lit("-"), F.lit(1))


def truncate(c: Column) -> Column:
    """``int(x)``: toward zero, exact for decimals."""
    # int() of the reference: toward zero (floor would be wrong on negatives).
    return F.when(c >= 0, F.floor(c)).otherwise(F.ceil(c))

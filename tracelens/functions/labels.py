"""Label expressions over scan reports held as maps (L1-L4, A5).

A scan report is ``MAP<engine, STRUCT<detected: BOOLEAN>>`` under ``vti.scans``
or ``existing.scans``.  These are per-document expressions (higher-order
functions, no UDF); the long-form operators in ``operators.labelling`` do the
same over a ``(sample, engine, detected)`` table.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Label encoding and the default detection threshold.
MALWARE = 1.0
BENIGN = 0.0
DEFAULT_PCOUNT_MIN = 5


def scan_data(vti: Column, existing: Column) -> Column:
    """``vti.scans`` when the vti report has scans, else ``existing.scans`` (L1)."""
    return F.when(vti.isNotNull() & vti.getField("scans").isNotNull(), vti.getField("scans")).otherwise(
        F.when(existing.isNotNull(), existing.getField("scans"))
    )


def count_detections(scans: Column) -> Column:
    """Engines whose ``detected`` is strictly true (A5)."""
    return F.size(F.filter(F.map_values(scans), lambda s: s.getField("detected") == F.lit(True)))


def label_by_count(detected: Column, pcount_min: int = DEFAULT_PCOUNT_MIN) -> Column:
    """Malware iff detections > ``pcount_min`` (L2); null detections -> null."""
    return F.when(detected.isNull(), F.lit(None).cast("double")).when(
        detected > F.lit(pcount_min), F.lit(MALWARE)
    ).otherwise(F.lit(BENIGN))


def label_by_percent(detected: Column, engines: Column, pcount_perc: float) -> Column:
    """Malware iff detections / engines * 100 > ``pcount_perc`` (L3).

    No engines -> null (the reference divides by zero there).
    """
    pct = F.try_divide(detected.cast("double"), engines.cast("double")) * F.lit(100.0)
    return F.when(pct.isNull(), F.lit(None).cast("double")).when(pct > F.lit(float(pcount_perc)), F.lit(MALWARE)).otherwise(
        F.lit(BENIGN)
    )


def explicit_label(label: Column) -> Column:
    """'malware' -> 1.0, 'benign' -> 0.0, absent -> null, anything else -> error (L4)."""
    return (
        F.when(label.isNull(), F.lit(None).cast("double"))
        .when(label == "malware", F.lit(MALWARE))
        .when(label == "benign", F.lit(BENIGN))
        .otherwise(F.raise_error(F.concat(F.lit("unknown label: "), label)).cast("double"))
    )


def resolve_label(explicit: Column, scanned: Column, mode: str = "default") -> Column:
    """Explicit label first, then the scan-based one.

    ``mode='vti_only'`` uses the scan label only and never evaluates the
    explicit one (so an unknown explicit label is not an error there);
    ``'explicit_only'`` uses the explicit label only.
    """
    if mode == "vti_only":
        return scanned
    if mode == "explicit_only":
        return explicit
    if mode != "default":
        raise ValueError(f"unknown label mode {mode!r}")
    return F.coalesce(explicit, scanned)

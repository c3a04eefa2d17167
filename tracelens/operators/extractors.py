"""Extractors by name and version, chosen by an upload's pack.

An extractor is a function (traces, keys) -> features: rows of the keys,
``feature`` and ``feature_data``. Packs name the extractors that an upload goes
through. All extractors that the packs at hand name run in one plan. The traces
are read once: when several extractors need them, what they need is staged.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.catalog import PACK_EXTRACTORS
from ..session import stage_table
from .chunks import FEATURE_VERSION, chunk_deltas
from .histogram import feature_vectors

Extractor = Callable[[DataFrame, Sequence[str]], DataFrame]
#: (name, version) -> extractor.
REGISTRY: dict[tuple[str, str], Extractor] = {}
UPLOAD_KEYS = ("sample", "uuid", "run_id")
#: Bits of an address within its page.
PAGE_BITS = 12


class UnknownPack(ValueError):
    """A pack that no table of packs names, or one that names an extractor nobody registered."""


def extractor(name: str, version: str = FEATURE_VERSION):
    """Registers an extractor; a name and version can be taken once."""

    def take(make: Extractor) -> Extractor:
        if (name, version) in REGISTRY:
            raise ValueError(f"extractor {name} {version} is registered already")
        REGISTRY[name, version] = make
        return make

    return take


def newest(name: str) -> tuple[str, str]:
    """An extractor's name with the newest of its versions."""
    versions = [v for n, v in REGISTRY if n == name]
    if not versions:
        raise UnknownPack(f"no extractor {name!r} is registered")
    return name, max(versions, key=lambda v: [int(x) for x in v.split(".")])


def mem_rw_dump(sizes: Sequence[int] | None = None, order_cols: Sequence[str] = ("seq",), ranges=None) -> Extractor:
    """The histograms of chunk deltas, for traces with these settings."""

    def extract(traces: DataFrame, keys: Sequence[str]) -> DataFrame:
        deltas = chunk_deltas(traces, keys, *([sizes] if sizes else []), order_cols=order_cols)
        vectors = feature_vectors(deltas, keys, *([ranges] if ranges else []))
        return vectors.select(*keys, "feature", F.col("feature_data").cast("array<long>").alias("feature_data"))

    return extract


extractor("ext-mem-rw-dump")(mem_rw_dump())


@extractor("ext-access-summary")
def access_summary(traces: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One feature per kind of access: accesses, pages touched, lowest and highest address."""
    page = F.shiftright("tgt", PAGE_BITS)
    counted = traces.groupBy(*keys, "rw", page.alias("page")).agg(F.count(F.lit(1)).alias("n"), F.min("tgt").alias("low"), F.max("tgt").alias("high"))
    whole = counted.groupBy(*keys, "rw").agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("pages"), F.min("low").alias("low"), F.max("high").alias("high"))
    return whole.select(*keys, F.concat("rw", F.lit("-access-summary")).alias("feature"), F.array("n", "pages", "low", "high").cast("array<long>").alias("feature_data"))


def extract_by_pack(
    uploads: DataFrame,
    traces: DataFrame,
    packs: Mapping[str, Sequence[str | tuple[str, str]]] = PACK_EXTRACTORS,
    extractors: Mapping[tuple[str, str], Extractor] | None = None,
    keys: Sequence[str] = UPLOAD_KEYS,
    pack_col: str = "extractor_pack",
    on_unknown: str = "raise",
) -> DataFrame:
    """Features of the uploads' traces by every extractor of their packs: keys, feature_set_name, feature_set_ver, feature, feature_data.

    A pack lists extractors by name (the newest version) or by (name,
    version). An upload with an unknown or null pack is an error with
    ``on_unknown="raise"`` and has no features with ``"skip"``. ``extractors`` takes
    the place of the registry's entries of the same name and version.
    """
    if on_unknown not in ("raise", "skip"):
        raise ValueError(f"on_unknown is raise or skip, not {on_unknown!r}")
    known = {**REGISTRY, **(extractors or {})}
    plan = {p: [newest(x) if isinstance(x, str) else tuple(x) for x in names] for p, names in packs.items()}
    missing = sorted({x for names in plan.values() for x in names if x not in known})
    if missing:
        raise UnknownPack(f"no extractor {missing[0]!r} is registered")
    asked = {r[0] for r in uploads.select(pack_col).distinct().where(F.col(pack_col).isNull() | F.col(pack_col).isin(list(plan))).collect()}  # a row a known pack
    strange = uploads.where(F.col(pack_col).isNull() | ~F.col(pack_col).isin(list(plan))).select(pack_col).take(1)
    if strange and on_unknown == "raise":
        raise UnknownPack(f"unknown pack {strange[0][0]!r}")
    wanted = uploads.select(*keys, pack_col).distinct()
    used = sorted({x for p in asked if p is not None for x in plan[p]})
    mine = traces.join(wanted.where(F.col(pack_col).isin(list(plan))).select(*keys).distinct(), list(keys), "left_semi")
    if len(used) > 1:
        mine = stage_table(mine, "pack-traces")
    out = None
    for name, version in used:
        of = [p for p, names in plan.items() if (name, version) in names]
        rows = mine
        if asked - {None} - set(of):  # some uploads at hand are not for this extractor
            rows = mine.join(wanted.where(F.col(pack_col).isin(of)).select(*keys).distinct(), list(keys), "left_semi")
        found = known[name, version](rows, list(keys)).select(*keys, F.lit(name).alias("feature_set_name"), F.lit(version).alias("feature_set_ver"), "feature", F.col("feature_data").cast("array<long>").alias("feature_data"))
        out = found if out is None else out.unionByName(found)
    if out is None:
        kinds = ", ".join(f"`{k}` {uploads.schema[k].dataType.simpleString()}" for k in keys)
        out = uploads.sparkSession.createDataFrame([], f"{kinds}, feature_set_name string, feature_set_ver string, feature string, feature_data array<bigint>")
    return out

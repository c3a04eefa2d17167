"""Lookups of the reference expressed as joins.

Join strategy is left to Catalyst/AQE: the lookup tables here are either
fixed constants (the pack map, a few rows: broadcast) or data-sized (left to
AQE, which broadcasts only what it measures under the threshold).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.catalog import PACK_EXTRACTORS, PACK_FAMILIES


def features_with_label(features: DataFrame, labelled: DataFrame, label_col: str = "label_value") -> DataFrame:
    """Feature rows with the label of their sample (J2); unlabelled dropped."""
    return features.join(labelled.select("sample", label_col), on="sample", how="inner").where(
        F.col(label_col).isNotNull()
    )


def sample_set_features(sample_set: DataFrame, features: DataFrame, sets_col: str | None = None) -> DataFrame:
    """Feature rows of the samples in a sample set (J3); empty documents dropped."""
    f = features if sets_col is None else features.where(F.col(sets_col) > 0)
    return sample_set.join(f, on="sample", how="inner")


def unprocessed(catalogue: DataFrame, in_flight: DataFrame, col: str = "sample") -> DataFrame:
    """Catalogue samples that are not in flight."""
    return catalogue.join(in_flight.select(col), on=col, how="left_anti")


def samples_without_metadata(catalogue: DataFrame, metadata: DataFrame, col: str = "sample") -> DataFrame:
    """Catalogue samples that have no metadata document."""
    return catalogue.join(metadata.select(col), on=col, how="left_anti")


def samples_without_upload(catalogue: DataFrame, uploads: DataFrame, col: str = "sample") -> DataFrame:
    """Catalogue samples never uploaded."""
    return catalogue.join(uploads.select(col), on=col, how="left_anti")


def pack_table(spark: SparkSession) -> DataFrame:
    """The two fixed pack lookups side by side ``(pack, families, extractors)``: a few constant rows."""
    rows = [(p, PACK_FAMILIES.get(p, []), PACK_EXTRACTORS.get(p, [])) for p in sorted({*PACK_FAMILIES, *PACK_EXTRACTORS})]
    return spark.createDataFrame(rows, "pack string, families array<string>, extractors array<string>")


def pack_feature_map(uploads: DataFrame, pack_col: str = "extractor_pack") -> DataFrame:
    """Uploads with a row for each feature family and each extractor of their pack.

    The two lookups are independent maps, so a pack's families and extractors
    don't pair up by position; a pack without families or extractors keeps a
    row with a null there. The pack table is a fixed constant (size known), so it is broadcast; an
    unknown pack yields no extractor (inner join drops it).
    """
    packs = F.broadcast(pack_table(uploads.sparkSession))
    return uploads.join(packs, uploads[pack_col] == packs["pack"], "inner").select(
        *uploads.columns, F.explode_outer("families").alias("family"), "extractors"
    ).select(*uploads.columns, "family", F.explode_outer("extractors").alias("extractor"))


def attach_scan_report(samples: DataFrame, sidecars: DataFrame, path_col: str = "path") -> DataFrame:
    """Sidecar ``<file>.json`` report of each sample becomes ``existing``.

    ``sidecars`` holds ``(path, existing)`` where path is the sample file's
    path (the sidecar path minus ``.json``).
    """
    return samples.join(sidecars.select(path_col, "existing"), on=path_col, how="left")

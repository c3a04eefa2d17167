"""Depth-limited redaction of nested documents.

For documents with a schema; :func:`redact_json` takes JSON text with any keys.
Every dict (struct or map) found at nesting level ``maxdepth`` is replaced by
a constant; the top-level document is level 0.  Lists are not descended into.
Afterwards ``additional_info`` of the ``existing`` and ``vti`` reports is
replaced too.  The expression is generated from the schema, so it runs as
native nested ``struct`` / ``transform_values`` expressions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Redaction depth and marker used by the reference importer.
MAX_DEPTH = 4
REDACTED = "REDACTED"


def _is_dict(dt: T.DataType) -> bool:
    return isinstance(dt, (T.StructType, T.MapType))


def _cut(c: Column, dt: T.DataType, depth: int, maxdepth: int, repl: str) -> Column:
    def child(expr: Column, cdt: T.DataType) -> Column:
        if _is_dict(cdt):
            if depth == maxdepth - 1:
                return F.when(expr.isNotNull(), F.lit(repl))  # an absent dict stays absent
            return _cut(expr, cdt, depth + 1, maxdepth, repl)
        return expr

    if isinstance(dt, T.StructType):
        if not dt.fields:
            return c
        body = F.struct(*[child(c.getField(f.name), f.dataType).alias(f.name) for f in dt.fields])
        return F.when(c.isNotNull(), body)
    if isinstance(dt, T.MapType):
        return F.transform_values(c, lambda _k, v: child(v, dt.valueType))
    return c


def redact_below_depth(df: DataFrame, maxdepth: int = MAX_DEPTH, replaced_with: str = REDACTED) -> DataFrame:
    """Apply the depth cut to every top-level column (the row is the document)."""
    cols = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if _is_dict(f.dataType):
            # A top-level column is a child of the document: level 1.
            out = F.when(c.isNotNull(), F.lit(replaced_with)) if maxdepth == 1 else _cut(c, f.dataType, 1, maxdepth, replaced_with)
        else:
            out = c
        cols.append(out.alias(f.name))
    return df.select(*cols)


def redact_reports(df: DataFrame, replaced_with: str = REDACTED) -> DataFrame:
    """Replace ``additional_info`` of the ``existing`` and ``vti`` structs."""
    for name in ("existing", "vti"):
        if name in df.columns and isinstance(df.schema[name].dataType, T.StructType):
            df = df.withColumn(
                name, F.when(F.col(name).isNotNull(), F.col(name).withField("additional_info", F.lit(replaced_with)))
            )
    return df


def redact_sample_document(df: DataFrame, maxdepth: int = MAX_DEPTH, replaced_with: str = REDACTED) -> DataFrame:
    """Depth cut followed by the report cut (what the sample upsert stores)."""
    return redact_reports(redact_below_depth(df, maxdepth, replaced_with), replaced_with)


_OBJECT = "map<string,variant>"


def _cut_variant(value: Column, depth: int, maxdepth: int, marker: Column) -> Column:
    """A value at ``depth``; objects below ``maxdepth`` are the marker. Only an object reads as a map."""
    entries = F.try_variant_get(value, "$", _OBJECT)
    if depth == maxdepth:
        return F.when(entries.isNotNull(), marker).otherwise(value)
    inner = F.transform_values(entries, lambda _k, v: _cut_variant(v, depth + 1, maxdepth, marker))
    return F.when(entries.isNotNull(), F.to_variant_object(inner)).otherwise(value)


def redact_json(document: Column, maxdepth: int = MAX_DEPTH, replaced_with: str = REDACTED, reports: tuple[str, ...] = ("existing", "vti")) -> Column:
    """A JSON document, whatever its keys, cut below ``maxdepth`` and without its reports' ``additional_info``.

    Undeclared keys stay, and are cut like any other. Lists and what is in
    them stay, as do nulls. A report that is there and is an object gets the marker as its
    ``additional_info``, there or not. The result is JSON text; null for text
    that is no JSON, and the value itself for JSON that is no object.
    """
    marker = F.parse_json(F.to_json(F.struct(F.lit(replaced_with).alias("m"))))
    marker = F.variant_get(marker, "$.m", "variant")
    whole = F.try_parse_json(document)
    top = F.try_variant_get(whole, "$", _OBJECT)

    def child(key: Column, value: Column) -> Column:
        cut = _cut_variant(value, 1, maxdepth, marker)
        entries = F.try_variant_get(cut, "$", _OBJECT)
        rest = F.map_filter(entries, lambda k, _v: k != "additional_info")
        told = F.to_variant_object(F.map_concat(rest, F.create_map(F.lit("additional_info"), marker)))
        return F.when(key.isin(list(reports)) & entries.isNotNull(), told).otherwise(cut)

    return F.when(top.isNotNull(), F.to_json(F.to_variant_object(F.transform_values(top, child)))).otherwise(F.to_json(whole))

"""JSON rows to typed columns with a list of what is wrong with each row."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions import iso_date
from tidemark.schemas import RAW, TableSpec

BAD = "_bad"
SEPARATOR = "\n"


def _checked_text(spec: TableSpec) -> set[str]:
    """Text columns whose JSON type matters: a number in a key is an error, not a text."""
    wanted = {*spec.required, *(["schema_version"] if spec.version else [])}
    return {f.name for f in spec.fields if f.name in wanted and f.dataType == T.StringType()}


WHOLE = T.DecimalType(38, 0)
# First characters of values other than text, and the type of a value that no parser reads.
OTHERS, UNREADABLE = '0123456789+-.tfNI[{"', ""


def _wire_schema(spec: TableSpec) -> T.StructType:
    """What the parser reads: counts as decimals, so that 7.0 is the count 7 and no error."""
    fields = []
    for field in spec.fields:
        kind = field.dataType
        if kind == T.DateType():
            kind = T.StringType()
        elif kind in (T.LongType(), T.IntegerType()):
            kind = WHOLE
        fields.append(T.StructField(spec.source_name(field.name), kind))
    return T.StructType([*fields, T.StructField(BAD, T.StringType())])


def _kind(text: str, spec: TableSpec, field: T.StructField) -> Column:
    """The JSON type of a checked field that has a value, as ``schema_of_variant`` names it.

    The parser gives other values as text too, so a value that may be one is looked up in the
    source: where every mention of the field is followed by a quote it is text. Else, and with
    escapes or single quotes about, which may hide a mention, a second parse tells.
    """
    name = spec.source_name(field.name)
    source, first = F.col(text), F.substring(F.col("_row")[name], 1, 1)
    if field.dataType == T.DateType():
        doubt = first.isin(*"{[")  # no day, but still to be readable
    else:
        mention = source.rlike(rf'"{re.escape(name)}"\s*+:\s*+(?!"|null)')
        hidden = F.contains(source, F.lit("\\")) | F.contains(source, F.lit("'"))
        doubt = first.isin(*OTHERS) & (mention | hidden)
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": BAD}
    wire = T.StructType([T.StructField(name, T.VariantType()), T.StructField(BAD, T.StringType())])
    known = F.schema_of_variant(F.from_json(source, wire, options)[name])
    return F.when(doubt, F.coalesce(known, F.lit(UNREADABLE))).otherwise("STRING")


def _with_values(parsed: DataFrame, text: str, spec: TableSpec) -> DataFrame:
    """Adds the JSON types and the values that both columns and faults read, each found once per row.

    Apart from them, the generated methods also stay short enough to be compiled.
    """
    checked = _checked_text(spec)
    added = {}
    for field in spec.fields:
        value = F.col("_row")[spec.source_name(field.name)]
        if field.dataType == T.DateType():
            added[f"_value_{field.name}"] = iso_date(value)
        elif field.dataType in (T.LongType(), T.IntegerType()):
            added[f"_value_{field.name}"] = value.try_cast(field.dataType)
        if field.name in checked or field.dataType == T.DateType():
            added[f"_kind_{field.name}"] = _kind(text, spec, field)
    return parsed.withColumns(added)


def _column(spec: TableSpec, field: T.StructField, checked: set[str]) -> Column:
    value = F.col("_row")[spec.source_name(field.name)]
    if field.name in checked:
        return F.when(F.col(f"_kind_{field.name}") == "STRING", value).alias(field.name)
    if field.dataType in (T.DateType(), T.LongType(), T.IntegerType()):
        return F.col(f"_value_{field.name}").alias(field.name)
    return value.alias(field.name)


def _faults(spec: TableSpec, checked: set[str]) -> Column:
    """Array of messages, empty for a good row."""
    found = []
    undecodable = F.col("_row").isNull() | F.col("_row")[BAD].isNotNull()
    for field in spec.fields:
        name = field.name
        value = F.col("_row")[spec.source_name(name)]
        absent = value.isNull()
        if name in spec.required:
            found.append(F.when(absent, f"{name}: missing"))
        if field.dataType == T.DateType():
            undecodable = undecodable | (F.col(f"_kind_{name}") == UNREADABLE)
            found.append(F.when(~absent & F.col(f"_value_{name}").isNull(), f"{name}: not a date"))
        elif name in checked:
            undecodable = undecodable | (F.col(f"_kind_{name}") == UNREADABLE)
            found.append(F.when(F.col(f"_kind_{name}") != "STRING", f"{name}: not text"))
        elif field.dataType in (T.LongType(), T.IntegerType()):
            found.append(F.when(~absent & F.col(f"_value_{name}").isNull(), f"{name}: out of range"))
    # Joined and split again: functions over arrays would take the projection out of codegen.
    joined = F.when(undecodable, "undecodable").otherwise(F.concat_ws(SEPARATOR, *found))
    none = F.array().cast("array<string>")
    return F.when(joined == "", none).otherwise(F.split(joined, SEPARATOR))


def decode_rows(rows: DataFrame, spec: TableSpec, text: str = "value") -> DataFrame:
    """Parse one JSON object per row into the table's columns.

    The source text stays as ``raw_json``, so fields outside the contract are kept; a spec may ask
    for it parsed as VARIANT, null where it cannot be. ``faults``
    lists undecodable text, missing or mistyped keys, unreadable days and counts too large for
    their column; no row is dropped.
    """
    checked = _checked_text(spec)
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": BAD}
    # One-element explode: filters on the result stay above it, so each text is parsed once.
    once = F.explode(F.array(F.from_json(text, _wire_schema(spec), options)))
    parsed = _with_values(rows.withColumn("_row", once), text, spec)
    others = [name for name in rows.columns if name != text]
    return parsed.select(
        *[_column(spec, field, checked) for field in spec.fields],
        (F.try_parse_json(text) if spec.variant else F.col(text)).alias(RAW),
        _faults(spec, checked).alias("faults"),
        *others,
    )


def raw_field(rows: DataFrame, path: str, kind: str = "string") -> Column:
    """A field of the source item, in the contract or not; null if absent or of another kind.

    Stored VARIANTs are read as they are, stored text is parsed.
    """
    raw = F.col(RAW)
    if rows.schema[RAW].dataType != T.VariantType():
        raw = F.try_parse_json(raw)
    return F.try_variant_get(raw, path, kind)


def split_valid(decoded: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(good rows, quarantined rows) of a decoded export."""
    clean = F.size("faults") == 0
    return decoded.where(clean).drop("faults"), decoded.where(~clean)

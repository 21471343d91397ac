"""The catalog record as a Spark schema, and its documentation."""

from __future__ import annotations

from pyspark.sql import types as T

_TEXT, _DAY, _INT, _LONG = T.StringType(), T.DateType(), T.IntegerType(), T.LongType()


def _struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(n, k) for n, k in fields.items()])


def _list(kind: T.DataType = _TEXT) -> T.ArrayType:
    return T.ArrayType(kind)


RECORD = _struct(
    id=_TEXT, source=_TEXT, source_native_id=_TEXT, name=_TEXT, summary=_TEXT, url=_TEXT, dataset_doi=_TEXT, version=_TEXT, published=_DAY,
    domains=_list(), modalities=_list(), conditions=_list(_struct(label=_TEXT, mesh_id=_TEXT)), keywords=_list(), population=_TEXT, species=_TEXT,
    sample_size=_LONG, sample_unit=_TEXT, size_bytes=_LONG, countries=_list(), years=_struct(start=_INT, end=_INT),
    access=_TEXT, access_tiers=_list(), access_notes=_TEXT, access_howto=_TEXT, license=_TEXT,
    institutions=_list(_struct(name=_TEXT, ror_id=_TEXT, country=_TEXT)), authors=_list(_struct(name=_TEXT, orcid=_TEXT)),
    papers=_list(_struct(doi=_TEXT, title=_TEXT, relation=_TEXT)), related=_list(_struct(id=_TEXT, relation=_TEXT)), record_status=_TEXT,
    provenance=_struct(harvested_via=_TEXT, harvested_at=_DAY, last_verified=_DAY, raw_hash=_TEXT, enrichment=_struct(method=_TEXT, model=_TEXT, prompt_version=_TEXT, at=_DAY, fields=T.MapType(_TEXT, _TEXT))),
)

#: Required fields; the rest may be null or empty.
REQUIRED = ("id", "source", "source_native_id", "name", "summary", "url", "species", "access", "record_status", "provenance")


def unknown_fields(keys: set[str]) -> list[str]:
    """Top-level keys of a JSON object that the schema doesn't have: from_json would drop them in silence."""
    return sorted(keys - set(RECORD.names))


def json_schema() -> dict:
    """The record as JSON Schema."""

    def of(kind: T.DataType) -> dict:
        if isinstance(kind, T.StructType):
            return {"type": "object", "additionalProperties": False, "properties": {f.name: of(f.dataType) for f in kind}}
        if isinstance(kind, T.ArrayType):
            return {"type": "array", "items": of(kind.elementType)}
        if isinstance(kind, T.MapType):
            return {"type": "object", "additionalProperties": of(kind.valueType)}
        if isinstance(kind, T.DateType):
            return {"type": "string", "format": "date"}
        return {"type": "integer" if isinstance(kind, (T.IntegerType, T.LongType)) else "string"}

    return {**of(RECORD), "required": list(REQUIRED)}


def markdown() -> str:
    """The record as a Markdown table."""
    rows = [f"| `{f.name}` | `{f.dataType.simpleString()}` | {'yes' if f.name in REQUIRED else 'no'} |" for f in RECORD]
    return "\n".join(["| field | type | required |", "| --- | --- | --- |", *rows])

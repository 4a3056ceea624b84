"""A declared schema as native predicates: the keywords of a small JSON-Schema subset, compiled to one pass over the records."""

from __future__ import annotations

import json
import re
from collections.abc import Callable, Iterator
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

KEYWORDS = {"type", "required", "properties", "additionalProperties", "minLength", "pattern", "minimum", "maximum", "minItems", "uniqueItems", "items", "enum"}
IGNORED = {"$schema", "$id", "$defs", "title", "description", "default", "examples", "$ref"}
MAX_DEPTH = 100


class SchemaError(ValueError):
    """What is wrong with a schema file; code is one of encoding, json, duplicate_key, root, nesting_depth, reference, reference_cycle, invalid."""

    def __init__(self, code: str, message: str):
        super().__init__(message)
        self.code = code


def load_schema(data: bytes) -> dict:
    """Parses a schema strictly: UTF-8, no repeated key, no NaN or infinity, an object, no deep nesting, local references only."""

    def pairs(items: list[tuple[str, object]]) -> dict:
        keys = [k for k, _ in items]
        if len(set(keys)) != len(keys):
            raise SchemaError("duplicate_key", "a key is repeated")
        return dict(items)

    def constant(name: str) -> None:
        raise SchemaError("json", f"{name} is no JSON number")

    try:
        text = data.decode("utf-8")
    except UnicodeDecodeError as e:
        raise SchemaError("encoding", str(e)) from e
    try:
        schema = json.loads(text, object_pairs_hook=pairs, parse_constant=constant)
    except RecursionError as e:
        raise SchemaError("nesting_depth", "nested too deeply") from e
    except json.JSONDecodeError as e:
        raise SchemaError("json", str(e)) from e
    if not isinstance(schema, dict):
        raise SchemaError("root", "the schema is no object")
    level, depth = [schema], 0
    while level:
        depth += 1
        if depth > MAX_DEPTH:
            raise SchemaError("nesting_depth", "nested too deeply")
        level = [v for x in level for v in (x.values() if isinstance(x, dict) else x) if isinstance(v, (dict, list))]
    compiled(schema)
    return schema


def resolve(node: object, root: dict, trail: tuple[str, ...]) -> object:
    """The node with all local references put in."""
    if isinstance(node, list):
        return [resolve(x, root, trail) for x in node]
    if not isinstance(node, dict):
        return node
    if "$ref" in node:
        ref = node["$ref"]
        if not isinstance(ref, str) or not ref.startswith("#"):
            raise SchemaError("reference", f"{ref!r} is not local")
        if ref in trail:
            raise SchemaError("reference_cycle", f"{ref} leads back to itself")
        target: object = root
        for part in ref[1:].split("/")[1:]:
            part = part.replace("~1", "/").replace("~0", "~")
            if not isinstance(target, dict) or part not in target:
                raise SchemaError("reference", f"{ref} leads nowhere")
            target = target[part]
        return resolve(target, root, (*trail, ref))
    return {k: resolve(v, root, trail) for k, v in node.items() if k != "$defs"}


def _is_count(x: object) -> bool:
    return isinstance(x, int) and not isinstance(x, bool) and x >= 0


def _is_number(x: object) -> bool:
    return isinstance(x, (int, float)) and not isinstance(x, bool)


def _is_pattern(x: object) -> bool:
    try:
        return isinstance(x, str) and re.compile(x) is not None
    except re.error:
        return False


#: What each keyword may say; a schema that says something else is no schema.
SHAPES: dict[str, Callable[[object], bool]] = {
    "type": lambda x: x in TYPES,
    "required": lambda x: isinstance(x, list) and all(isinstance(k, str) for k in x) and len(set(x)) == len(x),
    "properties": lambda x: isinstance(x, dict) and all(isinstance(v, dict) for v in x.values()),
    "additionalProperties": lambda x: isinstance(x, bool),
    "minLength": _is_count,
    "minItems": _is_count,
    "minimum": _is_number,
    "maximum": _is_number,
    "pattern": _is_pattern,
    "uniqueItems": lambda x: isinstance(x, bool),
    "items": lambda x: isinstance(x, dict),
    "enum": lambda x: isinstance(x, list) and bool(x),
}
#: Types, each with the test of a plain value.
TYPES: dict[str, Callable[[object], bool]] = {
    "string": lambda v: isinstance(v, str),
    "integer": lambda v: _is_number(v) and v == v and abs(v) != float("inf") and v == int(v),
    "number": _is_number,
    "boolean": lambda v: isinstance(v, bool),
    "array": lambda v: isinstance(v, list),
    "object": lambda v: isinstance(v, dict),
    "null": lambda v: v is None,
}


def compiled(schema: dict) -> dict:
    """The schema with references put in, after each keyword was looked at."""
    full = resolve(schema, schema, ())
    for node in _nodes(full):
        unknown = set(node) - KEYWORDS - IGNORED
        if unknown:
            raise SchemaError("invalid", f"keywords that aren't supported: {sorted(unknown)}")
        for keyword in KEYWORDS & set(node):
            if not (isinstance(node[keyword], str) and node[keyword] in TYPES if keyword == "type" else SHAPES[keyword](node[keyword])):
                raise SchemaError("invalid", f"{keyword} may not be {node[keyword]!r}")
    return full


def _told_apart(value: object) -> str:
    return json.dumps(value, sort_keys=True, default=str)


#: Keywords about one plain value, each with the test that tells a violation; ``type`` comes first and ends the matter.
CHECKS: dict[str, Callable[[object, object], bool]] = {
    "minLength": lambda v, n: isinstance(v, str) and len(v) < n,
    "pattern": lambda v, p: isinstance(v, str) and re.search(p, v) is None,
    "minimum": lambda v, n: _is_number(v) and v < n,
    "maximum": lambda v, n: _is_number(v) and v > n,
    "minItems": lambda v, n: isinstance(v, list) and len(v) < n,
    "uniqueItems": lambda v, on: on and isinstance(v, list) and len({_told_apart(x) for x in v}) < len(v),
    "enum": lambda v, known: _told_apart(v) not in {_told_apart(k) for k in known},
}


def violations_of(schema: dict, value: object, path: str = "$") -> Iterator[tuple[str, str]]:
    """``(code, path)`` of what breaks a compiled schema in a plain value, as a parser meets it: types are looked at as well.

    A missing property is reported at its own path, properties beyond the schema once at the object.
    """
    if "type" in schema and not TYPES[schema["type"]](value):
        yield "schema.type", path
        return
    for keyword in CHECKS:
        if keyword in schema and CHECKS[keyword](value, schema[keyword]):
            yield f"schema.{keyword}", path
    if isinstance(value, dict):
        parts = schema.get("properties", {})
        for name in schema.get("required", []):
            if name not in value:
                yield "schema.required", f"{path}.{name}"
        if schema.get("additionalProperties") is False and not value.keys() <= parts.keys():
            yield "schema.additionalProperties", path
        for name in value.keys() & parts.keys():
            yield from violations_of(parts[name], value[name], f"{path}.{name}")
    if isinstance(value, list) and "items" in schema:
        for i, one in enumerate(value):
            yield from violations_of(schema["items"], one, f"{path}[{i}]")


def violations(schema: dict, value: Column, kind: T.DataType, path: Column, required: bool = False) -> Iterator[Column]:
    """Array columns of ``struct(code, path)`` for one node; a value that is missing breaks nothing but ``required``."""

    def when(code: str, bad: Column) -> Column:
        return F.when(F.coalesce(bad, F.lit(False)), F.array(F.struct(F.lit(f"schema.{code}").alias("code"), path.alias("path"))))

    there = value.isNotNull()
    if required:
        yield when("required", value.isNull())
    if isinstance(kind, T.StringType):
        if "minLength" in schema:
            yield when("minLength", there & (F.length(value) < schema["minLength"]))
        if "pattern" in schema:
            yield when("pattern", there & ~value.rlike("(?U)" + schema["pattern"]))
        if schema.get("type") in ("integer", "number", "array", "object", "boolean"):
            yield when("type", there)
    if isinstance(kind, T.NumericType):
        if schema.get("type") == "integer":
            yield when("type", there & (value != F.floor(value)))
        if schema.get("type") in ("string", "array", "object", "boolean"):
            yield when("type", there)
        if "minimum" in schema:
            yield when("minimum", there & (value < schema["minimum"]))
        if "maximum" in schema:
            yield when("maximum", there & (value > schema["maximum"]))
    if "enum" in schema:
        yield when("enum", there & ~value.isin(schema["enum"]))
    if isinstance(kind, T.StructType):
        needed = set(schema.get("required", []))
        parts = schema.get("properties", {})
        if schema.get("additionalProperties") is False:
            extra: list[Column] = []
            for f in kind.fields:
                if f.name not in parts:
                    extra.append(value[f.name].isNotNull())
            if extra:
                yield when("additionalProperties", there & reduce(or_, extra))
        for name, part in parts.items():
            if name in kind.names:
                for found in violations(part, value[name], kind[name].dataType, F.concat(path, F.lit(f".{name}")), name in needed):
                    yield F.when(there, found)
            elif name in needed:
                yield when("required", there)
    if isinstance(kind, T.ArrayType):
        if "minItems" in schema:
            yield when("minItems", there & (F.size(value) < schema["minItems"]))
        if schema.get("uniqueItems"):
            yield when("uniqueItems", there & (F.size(F.array_distinct(value)) < F.size(value)))
        if "items" in schema:

            def each(x: Column, i: Column) -> Column:
                inner = list(violations(schema["items"], x, kind.elementType, F.concat(path, F.lit("["), i.cast("string"), F.lit("]"))))
                none = F.array().cast("array<struct<code:string,path:string>>")
                return F.concat(*[F.coalesce(c, none) for c in inner]) if inner else none

            yield F.flatten(F.transform(value, each))


def violations_column(records: DataFrame, schema: dict, leave_out: set[str]) -> Column:
    """All violations of a row as one array of ``struct(code, path)``; columns in ``leave_out`` don't belong to the record."""
    full = compiled(schema)
    kind = T.StructType([f for f in records.schema.fields if f.name not in leave_out])
    none = F.array().cast("array<struct<code:string,path:string>>")
    found = [F.coalesce(c, none) for c in violations(full, F.struct(*kind.names), kind, F.lit("$"))]
    return F.concat(*found) if found else none


def check(records: DataFrame, schema: dict, id_col: str) -> DataFrame:
    """``(id, code, path)`` of all violations, in one pass: every rule is an expression of the same projection.

    Columns the schema doesn't name count as additional, but for the id. Records that were read from files bring what
    their parser saw (column broken), since a typed column can't hold a value of another type.
    """
    if "broken" in records.columns:
        return records.select(F.col(id_col), F.inline("broken"))
    return records.select(F.col(id_col), F.inline(violations_column(records, schema, {id_col})))


def _nodes(schema: dict) -> Iterator[dict]:
    yield schema
    for part in schema.get("properties", {}).values():
        yield from _nodes(part)
    if isinstance(schema.get("items"), dict):
        yield from _nodes(schema["items"])


def record_schema(id_pattern: str = "^[0-9]{9}$") -> dict:
    """The schema of a record with neutral column names."""
    text = {"type": "string", "minLength": 1}
    return {
        "type": "object",
        "additionalProperties": False,
        "required": ["document_type", "publication_stage", "title", "authors", "doi", "publication_year", "journal", "language_status", "file_status"],
        "properties": {
            "document_type": text, "publication_stage": text, "title": text, "journal": text, "language_status": text, "record_status": text, "record_notes": text,
            "authors": {"type": "array", "minItems": 1, "items": {"type": "object", "required": ["name"], "properties": {"name": text, "canonical_name": text}}},
            "doi": {"type": "string", "minLength": 1, "pattern": "^10\\.[0-9]{4,9}/\\S+$"},
            "publication_year": {"type": "integer", "minimum": 1800},
            "file_status": {"type": "object", "additionalProperties": False, "required": ["main_pdf", "supplementary_material", "full_text_html"], "properties": {"main_pdf": text, "supplementary_material": text, "full_text_html": text}},
            "related": {"type": "array", "uniqueItems": True, "items": {"type": "object", "required": ["record_id", "relationship_type"], "properties": {"record_id": {"type": "string", "pattern": id_pattern}, "relationship_type": text}}},
        },
    }

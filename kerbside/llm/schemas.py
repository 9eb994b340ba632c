"""Validation of JSON values against JSON Schema, as far as tools' arguments need it; a schema beyond that is refused, never half applied."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from fractions import Fraction
from typing import Any

Schema = dict[str, Any] | bool

_TYPES = {"string": str, "integer": int, "number": (int, float), "boolean": bool, "array": list, "object": dict, "null": type(None)}
#: Keywords whose values are schemas, lists of them, and maps to them.
_ONE, _MANY, _NAMED = ("additionalProperties", "items", "not"), ("oneOf", "anyOf", "allOf"), ("properties", "$defs", "definitions")
_NUMBERS = ("minimum", "maximum", "exclusiveMinimum", "exclusiveMaximum", "multipleOf")
_SIZES = ("minLength", "maxLength", "minItems", "maxItems", "minProperties", "maxProperties")
#: Keywords that say something about a schema and ask nothing of values.
_NOTES = ("title", "description", "default", "examples", "$schema", "$id", "$comment", "format", "deprecated")
KEYWORDS = {"type", "enum", "const", "required", "pattern", "uniqueItems", "$ref", *_ONE, *_MANY, *_NAMED, *_NUMBERS, *_SIZES, *_NOTES}


def _resolve(ref: str, root: Schema) -> Schema:
    """The part of a schema that a reference within it points to."""
    if not isinstance(ref, str) or not (ref == "#" or ref.startswith("#/")):
        raise ValueError(f"a reference outside the schema: {ref}")
    found: Any = root
    for name in ref[2:].split("/") if ref != "#" else []:
        name = name.replace("~1", "/").replace("~0", "~")
        if isinstance(found, list) and name.isdigit() and int(name) < len(found):
            found = found[int(name)]
        elif isinstance(found, dict) and name in found:
            found = found[name]
        else:
            raise ValueError(f"a reference to nothing: {ref}")
    return found


def _parts(schema: dict[str, Any]) -> Iterator[Schema]:
    for k in _ONE:
        if k in schema:
            yield schema[k]
    for k in _MANY:
        yield from schema.get(k, ())
    for k in _NAMED:
        yield from schema.get(k, {}).values()


def check_schema(schema: Schema, root: Schema | None = None) -> None:
    """ValueError for a schema with a keyword, type, pattern or reference that ``conforms`` would not apply, or references in a circle."""
    root = schema if root is None else root
    if isinstance(schema, bool):
        return
    if not isinstance(schema, dict):
        raise ValueError(f"no schema: {schema!r}")
    if unknown := set(schema) - KEYWORDS:
        raise ValueError(f"unknown keywords: {', '.join(sorted(unknown))}")
    kinds = schema.get("type", [])
    if unknown := set([kinds] if isinstance(kinds, str) else kinds) - set(_TYPES):
        raise ValueError(f"unknown types: {', '.join(sorted(unknown))}")
    for k in (*_NUMBERS, *_SIZES):
        if k in schema and (isinstance(schema[k], bool) or not isinstance(schema[k], int if k in _SIZES else (int, float)) or k == "multipleOf" and schema[k] <= 0):
            raise ValueError(f"{k} of {schema[k]!r}")
    if "pattern" in schema:
        try:
            re.compile(schema["pattern"])
        except (re.error, TypeError) as error:
            raise ValueError(f"no pattern: {schema['pattern']!r}") from error
    if "$ref" in schema:
        _resolve(schema["$ref"], root)
    _check_circle(schema, root, [])
    for part in _parts(schema):
        check_schema(part, root)


def _check_circle(schema: Schema, root: Schema, above: list[int]) -> None:
    """Schemas applied to one and the same value must not lead back to themselves."""
    if not isinstance(schema, dict):
        return
    if id(schema) in above:
        raise ValueError("references in a circle")
    here = [*above, id(schema)]
    if "$ref" in schema:
        _check_circle(_resolve(schema["$ref"], root), root, here)
    for part in (*(p for k in _MANY for p in schema.get(k, ())), *([schema["not"]] if "not" in schema else [])):
        _check_circle(part, root, here)


def _is_number(value: Any) -> bool:
    return isinstance(value, (int, float)) and not isinstance(value, bool)


def conforms(value: Any, schema: Schema, canonical: Callable[[Any], str], root: Schema | None = None) -> bool:
    """Whether a JSON value fits a schema that ``check_schema`` has passed. Values are equal if their ``canonical`` texts are."""
    root = schema if root is None else root
    if isinstance(schema, bool):
        return schema

    def fits(v: Any, s: Schema) -> bool:
        return conforms(v, s, canonical, root)

    kinds = schema.get("type", list(_TYPES))
    kinds = [kinds] if isinstance(kinds, str) else kinds
    if not any(isinstance(value, _TYPES[k]) and not (isinstance(value, bool) and k in ("integer", "number")) for k in kinds):
        return False
    if "enum" in schema and canonical(value) not in map(canonical, schema["enum"]) or "const" in schema and canonical(value) != canonical(schema["const"]):
        return False
    if "$ref" in schema and not fits(value, _resolve(schema["$ref"], root)):
        return False
    if not all(fits(value, s) for s in schema.get("allOf", ())) or "anyOf" in schema and not any(fits(value, s) for s in schema["anyOf"]):
        return False
    if "oneOf" in schema and sum(fits(value, s) for s in schema["oneOf"]) != 1 or "not" in schema and fits(value, schema["not"]):
        return False
    if _is_number(value):
        low, high = schema.get("minimum", value), schema.get("maximum", value)
        if not low <= value <= high or "exclusiveMinimum" in schema and value <= schema["exclusiveMinimum"] or "exclusiveMaximum" in schema and value >= schema["exclusiveMaximum"]:
            return False
        return "multipleOf" not in schema or (Fraction(str(value)) / Fraction(str(schema["multipleOf"]))).denominator == 1
    size = len(value) if isinstance(value, (str, list, dict)) else 0
    if isinstance(value, str):
        return schema.get("minLength", 0) <= size <= schema.get("maxLength", size) and ("pattern" not in schema or re.search(schema["pattern"], value) is not None)
    if isinstance(value, list):
        if not schema.get("minItems", 0) <= size <= schema.get("maxItems", size) or schema.get("uniqueItems") and len(set(map(canonical, value))) < size:
            return False
        return "items" not in schema or all(fits(v, schema["items"]) for v in value)
    if isinstance(value, dict):
        known, more = schema.get("properties", {}), schema.get("additionalProperties", True)
        if not schema.get("minProperties", 0) <= size <= schema.get("maxProperties", size) or not set(schema.get("required", ())) <= set(value):
            return False
        return all(fits(v, known[k] if k in known else more) for k, v in value.items())
    return True

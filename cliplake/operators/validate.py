"""JSON-schema rules compiled to columns, and cross-field rules.

A schema becomes one array<string> column of messages; there is no Python per row,
and each value of a document is taken out of it once."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_TYPES = {"object": "OBJECT", "array": "ARRAY", "string": "STRING", "integer": "BIGINT", "boolean": "BOOLEAN", "null": "VOID"}
_NAME = re.compile(r"^[A-Za-z_][A-Za-z0-9_]*$")


def _is(kind: Column, name: str) -> Column:
    if name == "number":
        return kind.rlike("^(BIGINT|DOUBLE|FLOAT|DECIMAL)")
    if name in ("object", "array"):
        return kind.startswith(_TYPES[name])
    return kind == _TYPES[name]


def _json(value) -> str:
    return "null" if value is None else str(value).lower() if isinstance(value, bool) else str(value)


_TEXTS = "array<string>"


def _none() -> Column:
    return F.array().cast(_TEXTS)


def let(value: Column, body) -> Column:
    """body(value), with value computed once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _known(messages: Column) -> Column:
    return F.filter(messages, lambda m: m.isNotNull())


def _node(v: Column, body) -> Column:
    """body(value, kind) of a VARIANT, each computed once; kind is null where the value is missing."""
    return let(v, lambda x: let(F.schema_of_variant(x), lambda k: body(x, k)))


def _messages(v: Column, kind: Column, schema: dict, path: str, root: dict) -> Column:
    """array of messages (some null) for the value v at path; a missing value is checked by its parent's `required` only."""
    if "$ref" in schema:
        target = root
        for part in schema["$ref"].lstrip("#/").split("/"):
            target = target[part]
        return _messages(v, kind, target, path, root)
    text = F.try_variant_get(v, "$", "string")
    number = F.try_variant_get(v, "$", "double")
    there = kind.isNotNull()
    own: list[Column] = []
    more: list[Column] = []  # arrays of messages

    def fail(when: Column, message: str) -> None:
        own.append(F.when(F.coalesce(when, F.lit(False)), F.lit(f"{path}: {message}")))

    types = schema.get("type")
    types = [types] if isinstance(types, str) else types or []
    if types:
        good = F.lit(False)
        for t in types:
            good = good | _is(kind, t)
        fail(there & ~good, f"expected {' or '.join(types)}")
    values = schema.get("enum", [schema["const"]] if "const" in schema else None)
    if values is not None:
        named = [_json(x) for x in values if x is not None]
        ok = F.coalesce(text.isin(*named), F.lit(False)) if named else F.lit(False)
        if None in values:
            ok = ok | (kind == "VOID")
        fail(there & ~ok, f"not one of {', '.join(_json(x) for x in values)}")
    is_text, is_number, is_list = kind == "STRING", _is(kind, "number"), kind.startswith("ARRAY")
    if "minLength" in schema:
        fail(is_text & (F.length(text) < schema["minLength"]), f"shorter than {schema['minLength']}")
    if "pattern" in schema:
        fail(is_text & ~text.rlike(schema["pattern"]), "does not match the pattern")
    if schema.get("format") == "date-time":
        fail(is_text & (~text.rlike(r"^\d{4}-\d\d-\d\d[Tt ]\d\d:\d\d:\d\d(\.\d+)?([Zz]|[+-]\d\d:\d\d)$") | F.try_to_timestamp(text).isNull()), "not a date-time")
    if schema.get("format") == "uri":
        fail(is_text & ~text.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*:\S+$"), "not a uri")
    if "minimum" in schema:
        fail(is_number & (number < schema["minimum"]), f"less than {schema['minimum']}")
    if "maximum" in schema:
        fail(is_number & (number > schema["maximum"]), f"more than {schema['maximum']}")
    if "exclusiveMinimum" in schema:
        fail(is_number & (number <= schema["exclusiveMinimum"]), f"not more than {schema['exclusiveMinimum']}")
    if any(k in schema for k in ("minItems", "maxItems", "uniqueItems", "items")):
        more.append(F.when(is_list, let(F.try_variant_get(v, "$", "array<variant>"), lambda items: _list_messages(items, schema, path, root))).otherwise(_none()))
    is_object = kind.startswith("OBJECT")
    props = schema.get("properties", {})
    required = schema.get("required", [])
    away, closed = [n for n in required if n not in props], schema.get("additionalProperties") is False

    def children(take) -> list[Column]:
        out = []
        for name, sub in props.items():
            step = f".{name}" if _NAME.match(name) else f'["{name}"]'
            none = F.array(F.lit(f"{path}: lacks {name}")) if name in required else _none()
            out.append(_node(take(name, step), lambda x, k, sub=sub, step=step, none=none: F.when(k.isNull(), none).otherwise(_messages(x, k, sub, path + step, root))))
        return out

    def by_key(fields: Column) -> Column:
        keys = F.map_keys(fields)
        out = [F.when(~F.array_contains(keys, name), F.lit(f"{path}: lacks {name}")) for name in away]
        if closed:
            extra = F.filter(keys, lambda x: ~x.isin(*props)) if props else keys
            said = lambda e: F.when(F.size(e) > 0, F.concat(F.lit(f"{path}: does not allow "), F.array_join(F.array_sort(e), ", ")))
            out.append(let(extra, said))
        return F.concat(F.array(*out).cast(_TEXTS), *children(lambda name, step: F.try_element_at(fields, F.lit(name))))

    if away or closed:  # a value of a map is taken out once, with its keys
        more.append(F.when(is_object, let(F.try_variant_get(v, "$", "map<string,variant>"), by_key)).otherwise(_none()))
    elif props:
        more.append(F.when(is_object, F.concat(*children(lambda name, step: F.try_variant_get(v, "$" + step, "variant")))).otherwise(_none()))
    for sub in schema.get("allOf", []):
        if "if" in sub:
            holds = F.size(_known(_messages(v, kind, sub["if"], path, root))) == 0
            then, other = (_messages(v, kind, sub.get(k, {}), path, root) for k in ("then", "else"))
            more.append(F.when(there, F.when(holds, then).otherwise(other)).otherwise(_none()))
        else:
            more.append(_messages(v, kind, sub, path, root))
    if "anyOf" in schema:
        clean = F.lit(False)
        for sub in schema["anyOf"]:
            clean = clean | (F.size(_known(_messages(v, kind, sub, path, root))) == 0)
        fail(there & ~clean, "fits none of the alternatives")
    return F.concat(F.array(*own).cast(_TEXTS) if own else _none(), *more)


def _list_messages(items: Column, schema: dict, path: str, root: dict) -> Column:
    out = []
    if "minItems" in schema:
        out.append(F.when(F.size(items) < schema["minItems"], F.lit(f"{path}: fewer than {schema['minItems']} items")))
    if "maxItems" in schema:
        out.append(F.when(F.size(items) > schema["maxItems"], F.lit(f"{path}: more than {schema['maxItems']} items")))
    if schema.get("uniqueItems"):
        out.append(F.when(F.size(F.array_distinct(F.transform(items, lambda x: F.to_json(x)))) < F.size(items), F.lit(f"{path}: items are not unique")))
    if "items" in schema:
        first = lambda x, i: F.struct(i.alias("i"), F.get(_known(_node(x, lambda v, k: _messages(v, k, schema["items"], "$", root))), F.lit(0)).alias("m"))
        bad = F.filter(F.transform(items, first), lambda e: e["m"].isNotNull())
        one = F.get(bad, F.lit(0))
        out.append(F.when(F.size(bad) > 0, let(one, lambda e: F.concat(F.lit(f"{path}["), e["i"].cast("string"), F.lit("]"), F.substr(e["m"], F.lit(2))))))
    return F.array(*out).cast(_TEXTS)


def errors(document: Column, schema: dict) -> Column:
    """Sorted messages of a VARIANT document; empty if it is valid. A null document is one error."""

    def found(v: Column, kind: Column) -> Column:
        return F.when(v.isNull(), F.array(F.lit("$: not a JSON document"))).otherwise(F.array_sort(_known(_messages(v, kind, schema, "$", schema))))

    return _node(document, found)


def first_error(found: Column) -> Column:
    return F.get(found, F.lit(0))


def require(df: DataFrame, found: str) -> DataFrame:
    """df if no row has messages in the column `found`; the run fails on the first that has."""
    bad = F.size(found) > 0
    return df.withColumn(found, F.when(bad, F.raise_error(F.array_join(found, "; ")).cast("array<string>")).otherwise(F.col(found)))


def missing_fields(fields: dict[str, Column]) -> Column:
    """Names whose value is null, an empty text or an empty list; 0 is a value."""
    return F.filter(F.array(*[F.when(c.isNull() | (c.cast("string").isin("", "[]")), F.lit(n)) for n, c in fields.items()]), lambda x: x.isNotNull())


def shot_errors(shots: Column) -> Column:
    """Messages for an ordered array of struct(start_seconds, end_seconds): each ends after it starts and starts at or after all earlier ends, from 0 on."""
    start = F.struct(F.lit(0.0).alias("end"), F.array().cast("array<string>").alias("out"))

    def step(a: Column, s: Column) -> Column:
        new = F.filter(F.array(F.when(s["end_seconds"] <= s["start_seconds"], F.lit("shot ends before it starts")), F.when(s["start_seconds"] < a["end"], F.lit("shot overlaps an earlier one")), F.when(s["start_seconds"] < 0, F.lit("shot starts before 0"))), lambda m: m.isNotNull())
        return F.struct(F.greatest(a["end"], s["end_seconds"]).alias("end"), F.concat(a["out"], new).alias("out"))

    return F.aggregate(shots, start, step)["out"]


def hook_error(start: Column, end: Column) -> Column:
    return F.when(end <= start, F.lit("hook ends before it starts"))


def age_error(observed: Column, published: Column, age: Column) -> Column:
    """null unless all three are known and differ by more than a second."""
    real = (F.unix_micros(observed.cast("timestamp")) - F.unix_micros(published.cast("timestamp"))) / 1e6
    return F.when(F.abs(real - age) > 1.0, F.lit("age does not match the timestamps"))

"""JSON Schema compiled to column expressions over VARIANT, so that documents are checked inside the plan.

compile_schema() turns a schema document into one expression that gives the errors of a value, each with its path (a JSON Pointer)
and the keyword that it breaks, in the order in which the schema states them. Keywords of drafts 7 and 2020-12 that are understood: type, const, enum, required,
properties, patternProperties, additionalProperties, propertyNames (pattern and lengths), minProperties,
maxProperties, dependentRequired, items, prefixItems, additionalItems, contains, minItems, maxItems, uniqueItems, minLength,
maxLength, pattern, format, minimum, maximum, exclusiveMinimum, exclusiveMaximum, multipleOf, allOf, anyOf, oneOf, not, if, then, else, $ref.
Others are ignored, as the standard says. Patterns are Java's regular expressions. References lead into the schema itself or to documents that are
given; one that leads back into itself is refused, since an expression is finite.
"""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orolith.functions.urls import error_text, stem

ERRORS = "array<struct<path:string,keyword:string>>"
# What the formats look like. Dates are checked on the calendar besides.
_DAY, _TIME = r"\d{4}-(0[1-9]|1[0-2])-(0[1-9]|[12]\d|3[01])", r"([01]\d|2[0-3]):[0-5]\d:([0-5]\d|60)(\.\d+)?([Zz]|[+-]([01]\d|2[0-3]):[0-5]\d)"
FORMATS = {
    "date-time": rf"^{_DAY}[Tt]{_TIME}$", "date": rf"^{_DAY}$", "time": rf"^{_TIME}$", "uri": r"^[A-Za-z][A-Za-z0-9+.-]*:[^\s<>\"{}|\\^`]*$", "iri": r"^[A-Za-z][A-Za-z0-9+.-]*:[^\s<>\"{}|\\^`]*$",
    "uri-reference": r"^[^\s<>\"{}|\\^`]*$", "email": r"^[^@\s]+@[^@\s]+$", "uuid": r"^[0-9a-fA-F]{8}(-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}$", "ipv4": r"^((25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)(\.(?!$)|$)){4}$",
}


def _once(value: Column, then: Callable[[Column], Column]) -> Column:
    """The array then(value), with the value computed once however often then() uses it. Spark's get() would ask for the type of the whole expression in each row, flatten() doesn't."""
    return F.flatten(F.transform(F.array(value), lambda x: then(x)))


def _named_like(pattern: str) -> Callable[[Column], Column]:
    return lambda e: e["key"].rlike(pattern)


class _Value:
    """A VARIANT column by kind, with its members or elements, null where it has another kind."""

    def __init__(self, value: Column, members: Column, elements: Column, told: Column):
        self.value, self.members, self.elements, self.told = value, members, elements, told
        self.is_object, self.is_array, self.is_string, self.is_boolean, self.is_null = self.told.startswith("OBJECT"), self.told.startswith("ARRAY"), self.told == "STRING", self.told == "BOOLEAN", self.told == "VOID"
        self.is_number = ~(self.is_object | self.is_array | self.is_string | self.is_boolean | self.is_null)
        self.text, self.number = F.try_variant_get(value, "$", "string"), F.try_variant_get(value, "$", "double")

    @staticmethod
    def once(value: Column, then: Callable[["_Value"], Column]) -> Column:
        """then(value), an array, with its members, elements and kind computed once."""

        def kind(members: Column, elements: Column) -> Column:
            told = F.when(members.isNotNull(), "OBJECT").when(elements.isNotNull(), "ARRAY").otherwise(F.schema_of_variant(value))
            return _once(told, lambda t: then(_Value(value, members, elements, t)))

        array = lambda members: F.when(members.isNull(), F.try_variant_get(value, "$", "array<variant>"))
        return _once(F.try_variant_get(value, "$", "map<string,variant>"), lambda m: _once(array(m), lambda e: kind(m, e)))

    def member(self, name: str) -> Column:
        """A member of an object; null where it is absent, VARIANT's null where it is null."""
        return F.element_at(self.members, name)

    def is_a(self, kind: str) -> Column:
        if kind == "integer":
            return self.is_number & (self.number == F.floor(self.number))
        return {"object": self.is_object, "array": self.is_array, "string": self.is_string, "boolean": self.is_boolean, "null": self.is_null, "number": self.is_number}[kind]

    def equals(self, constant) -> Column:
        if constant is None:
            return self.is_null
        if isinstance(constant, bool):
            return self.is_boolean & (F.try_variant_get(self.value, "$", "boolean") == constant)
        if isinstance(constant, int | float):
            return self.is_number & (self.number == float(constant))
        if isinstance(constant, str):
            return self.is_string & (self.text == constant)
        return (self.is_array if isinstance(constant, list) else self.is_object) & (F.to_json(self.value) == json.dumps(constant, sort_keys=True, separators=(",", ":"), ensure_ascii=False))


class _Compiler:
    def __init__(self, documents: dict[str, dict]):
        self.documents = documents

    def none(self) -> Column:
        return F.array().cast(ERRORS)

    def one(self, at: Column, keyword: str) -> Column:
        return F.array(F.struct(at.alias("path"), F.lit(keyword).alias("keyword"))).cast(ERRORS)

    def refer(self, ref: str, root: dict) -> tuple[dict, dict]:
        """A reference's schema, and the document that it is in."""
        where, _, pointer = ref.partition("#")
        if where:
            root = self.documents[where]
        found = root
        for step in pointer.split("/")[1:]:
            step = step.replace("~1", "/").replace("~0", "~")
            found = found[int(step)] if isinstance(found, list) else found[step]
        return found, root

    def errors(self, schema, value: Column, at: Column, root: dict, seen: tuple = (), held: bool = False) -> Column:
        """The errors of a value; an absent one has none. The value and its kind are computed once, before all checks; held: the value is a column or variable already."""
        if isinstance(schema, bool):
            return self.none() if schema else F.when(value.isNotNull(), self.one(at, "false")).otherwise(self.none())

        told = lambda x: _Value.once(x, lambda v: self.joined(self.parts(schema, v, at, root, seen)))
        return F.when(value.isNull(), self.none()).otherwise(told(value)) if held else _once(value, lambda x: F.when(x.isNull(), self.none()).otherwise(told(x)))

    def joined(self, parts: list[Column]) -> Column:
        return self.none() if not parts else parts[0] if len(parts) == 1 else F.concat(*parts)

    def fits(self, schema, v: _Value, root: dict, seen: tuple) -> Column:
        return F.size(self.joined(self.parts(schema, v, F.lit(""), root, seen))) == 0

    def parts(self, schema, v: _Value, at: Column, root: dict, seen: tuple) -> list[Column]:
        value = v.value
        if isinstance(schema, bool):
            return [] if schema else [self.errors(schema, value, at, root, seen)]
        parts = []

        def check(keyword: str, applies: Column, ok: Column) -> None:
            parts.append(F.when(value.isNotNull() & applies & ~F.coalesce(ok, F.lit(False)), self.one(at, keyword)).otherwise(self.none()))

        def below(schema, value: Column, *steps: Column, held: bool = False) -> Column:
            return self.errors(schema, value, F.concat(at, *steps), root, seen, held)

        def has(keyword: str) -> bool:
            return keyword in schema

        every = F.lit(True)
        if has("$ref"):
            if schema["$ref"] in seen:
                raise ValueError(f"the schema refers back to itself by {schema['$ref']}")
            found, home = self.refer(schema["$ref"], root)
            parts += self.parts(found, v, at, home, (*seen, schema["$ref"]))
        if has("type"):
            kinds = schema["type"] if isinstance(schema["type"], list) else [schema["type"]]
            ok = F.lit(False)
            for kind in kinds:
                ok = ok | v.is_a(kind)
            check("type", every, ok)
        if has("const"):
            check("const", every, v.equals(schema["const"]))
        if has("enum"):
            ok = F.lit(False)
            for constant in schema["enum"]:
                ok = ok | v.equals(constant)
            check("enum", every, ok)
        for keyword, ok in (
            ("minLength", lambda n: F.char_length(v.text) >= n), ("maxLength", lambda n: F.char_length(v.text) <= n), ("pattern", lambda p: v.text.rlike(p)),
        ):
            if has(keyword):
                check(keyword, v.is_string, ok(schema[keyword]))
        if schema.get("format") in FORMATS:
            day = F.try_to_date(F.substring(v.text, 1, 10)).isNotNull() if schema["format"] in ("date", "date-time") else every
            check("format", v.is_string, v.text.rlike(FORMATS[schema["format"]]) & day)
        for keyword, ok in (
            ("minimum", lambda n: v.number >= n), ("maximum", lambda n: v.number <= n), ("exclusiveMinimum", lambda n: v.number > n), ("exclusiveMaximum", lambda n: v.number < n),
            ("multipleOf", lambda n: v.number / n == F.floor(v.number / n)),
        ):
            if has(keyword):
                check(keyword, v.is_number, ok(float(schema[keyword])))
        self.of_objects(schema, v, check, below, parts, at)
        self.of_arrays(schema, v, check, below, parts, root, seen)
        for sub in schema.get("allOf", ()):
            parts += self.parts(sub, v, at, root, seen)
        if has("anyOf"):
            ok = F.lit(False)
            for sub in schema["anyOf"]:
                ok = ok | self.fits(sub, v, root, seen)
            check("anyOf", every, ok)
        if has("oneOf"):
            check("oneOf", every, sum((self.fits(sub, v, root, seen).cast("int") for sub in schema["oneOf"]), F.lit(0)) == 1)
        if has("not"):
            check("not", every, ~self.fits(schema["not"], v, root, seen))
        if has("if"):
            one, other = (self.joined(self.parts(schema.get(k, True), v, at, root, seen)) for k in ("then", "else"))
            parts.append(F.when(value.isNull(), self.none()).when(self.fits(schema["if"], v, root, seen), one).otherwise(other))
        return parts

    def of_objects(self, schema: dict, v: _Value, check: Callable, below: Callable, parts: list[Column], at: Column) -> None:
        for name in schema.get("required", ()):
            check(f"required {name}", v.is_object, v.member(name).isNotNull())
        for name, needed in schema.get("dependentRequired", {}).items():
            for other in needed:
                check(f"dependentRequired {other}", v.is_object & v.member(name).isNotNull(), v.member(other).isNotNull())
        step = lambda name: F.replace(F.replace(name, F.lit("~"), F.lit("~0")), F.lit("/"), F.lit("~1"))
        for name, sub in schema.get("properties", {}).items():
            parts.append(below(sub, v.member(name), F.lit("/"), step(F.lit(name))))
        if "minProperties" in schema:
            check("minProperties", v.is_object, F.size(v.members) >= schema["minProperties"])
        if "maxProperties" in schema:
            check("maxProperties", v.is_object, F.size(v.members) <= schema["maxProperties"])
        entries = F.coalesce(F.map_entries(v.members), F.array().cast("array<struct<key:string,value:variant>>"))
        each = lambda some, sub: F.flatten(F.transform(some, lambda e: below(sub, e["value"], F.lit("/"), step(e["key"]))))
        for pattern, sub in schema.get("patternProperties", {}).items():
            parts.append(each(F.filter(entries, _named_like(pattern)), sub))
        if schema.get("additionalProperties", True) is not True:
            named, patterns = list(schema.get("properties", {})), list(schema.get("patternProperties", {}))

            def unnamed(e: Column) -> Column:
                free = ~e["key"].isin(named) if named else F.lit(True)
                for p in patterns:
                    free = free & ~e["key"].rlike(p)
                return free

            if schema["additionalProperties"] is False:
                check("additionalProperties", v.is_object, F.size(F.filter(entries, unnamed)) == 0)
            else:
                parts.append(each(F.filter(entries, unnamed), schema["additionalProperties"]))
        names = schema.get("propertyNames", {})
        if isinstance(names, dict) and names:
            good = lambda k: k.rlike(names.get("pattern", "")) & (F.char_length(k) >= names.get("minLength", 0)) & (F.char_length(k) <= names.get("maxLength", 1 << 30))
            check("propertyNames", v.is_object, F.forall(F.map_keys(v.members), good))

    def of_arrays(self, schema: dict, v: _Value, check: Callable, below: Callable, parts: list[Column], root: dict, seen: tuple) -> None:
        listed = schema.get("prefixItems", schema["items"] if isinstance(schema.get("items"), list) else [])
        rest = schema.get("additionalItems", True) if isinstance(schema.get("items"), list) else schema.get("items", True)
        for k, sub in enumerate(listed):
            parts.append(below(sub, F.get(v.elements, F.lit(k)), F.lit(f"/{k}")))
        if rest is not True:
            some = F.slice(F.coalesce(v.elements, F.array().cast("array<variant>")), len(listed) + 1, (1 << 31) - 1 - len(listed)) if listed else F.coalesce(v.elements, F.array().cast("array<variant>"))
            parts.append(F.flatten(F.transform(some, lambda x, k: below(rest, x, F.lit("/"), (k + len(listed)).cast("string"), held=True))))
        if "minItems" in schema:
            check("minItems", v.is_array, F.size(v.elements) >= schema["minItems"])
        if "maxItems" in schema:
            check("maxItems", v.is_array, F.size(v.elements) <= schema["maxItems"])
        if schema.get("uniqueItems"):
            texts = F.transform(v.elements, lambda x: F.to_json(x))
            check("uniqueItems", v.is_array, F.size(F.array_distinct(texts)) == F.size(texts))
        if "contains" in schema:
            check("contains", v.is_array, F.exists(v.elements, lambda x: F.size(self.errors(schema["contains"], x, F.lit(""), root, seen, True)) == 0))


def compile_schema(schema: dict | bool, value: Column, documents: dict[str, dict] | None = None) -> Column:
    """The errors (array of path and keyword) of a VARIANT column, empty where it fits. documents: schemas by the address that references name."""
    root = schema if isinstance(schema, dict) else {}
    return _Compiler(documents or {}).errors(schema, value, F.lit(""), root, held=True)


def with_errors(rows: DataFrame, schema: dict | bool, body: str = "body", documents: dict[str, dict] | None = None) -> DataFrame:
    """Adds errors of the documents in a text column: a null text is missing, one that isn't JSON (or repeats a key) breaks json."""
    kept = [c for c in rows.columns if c != "errors"]
    parsed = rows.select(*kept, F.explode(F.array(F.try_parse_json(F.col(body)))).alias("_value"))
    only = lambda keyword: F.array(F.struct(F.lit("").alias("path"), F.lit(keyword).alias("keyword"))).cast(ERRORS)
    found = F.when(F.col(body).isNull(), only("missing")).when(F.col("_value").isNull(), only("json")).otherwise(compile_schema(schema, F.col("_value"), documents))
    return parsed.select(*kept, found.alias("errors"))


def report(documents: DataFrame, schema: dict | bool, checked_at: str | None = None, others: dict[str, dict] | None = None) -> DataFrame:
    """Report rows of (item_path, body) as validate.report() gives them; the first error names the path and keyword."""
    rows = with_errors(documents.select("item_path", "body"), schema, "body", others)
    first = F.get("errors", F.lit(0))
    told = F.concat(F.when(first["path"] == "", "/").otherwise(first["path"]), F.lit(" "), first["keyword"])
    error = F.when(F.col("body").isNull(), "File not found").when(first["keyword"] == "json", error_text("JSON decode error", F.col("body"))).when(first.isNotNull(), error_text("Schema validation error", told))
    at = F.lit(checked_at) if checked_at else F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss")
    return rows.select("item_path", stem(F.col("item_path")).alias("item_id"), F.col("body").isNotNull().alias("json_exists"), (F.size("errors") == 0).alias("json_valid"), error.alias("validation_error"), at.alias("last_checked"))

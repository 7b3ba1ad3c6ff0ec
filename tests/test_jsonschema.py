"""The schema compiler against a plain evaluator, and its paths."""

import json
import random
import re

import pytest
from pyspark.sql import functions as F

from orolith.operators import jsonschema

MISSING = object()


def kind(v):
    return "null" if v is None else "boolean" if isinstance(v, bool) else "number" if isinstance(v, int | float) else "string" if isinstance(v, str) else "array" if isinstance(v, list) else "object"


def same(a, b):
    return kind(a) == kind(b) and (a == b if kind(a) not in ("array", "object") else json.dumps(a, sort_keys=True) == json.dumps(b, sort_keys=True))


def fits(s, v, root):
    """A direct reading of the keywords, without paths."""
    if isinstance(s, bool):
        return s
    k, ok = kind(v), True
    is_a = lambda t: k == t or t == "integer" and k == "number" and v == int(v)
    if "$ref" in s:
        ok &= fits(root["$defs"][s["$ref"].rsplit("/", 1)[1]], v, root)
    if "type" in s:
        ok &= any(is_a(t) for t in ([s["type"]] if isinstance(s["type"], str) else s["type"]))
    ok &= "const" not in s or same(s["const"], v)
    ok &= "enum" not in s or any(same(c, v) for c in s["enum"])
    if k == "string":
        ok &= s.get("minLength", 0) <= len(v) <= s.get("maxLength", 99) and bool(re.search(s.get("pattern", ""), v))
        ok &= s.get("format") != "date" or v in ("2020-02-29", "2021-01-31")
    if k == "number":
        ok &= s.get("minimum", -99) <= v <= s.get("maximum", 99) and v > s.get("exclusiveMinimum", -99) and ("multipleOf" not in s or v / s["multipleOf"] == v // s["multipleOf"])
    if k == "object":
        ok &= all(n in v for n in s.get("required", ())) and s.get("minProperties", 0) <= len(v)
        ok &= all(fits(sub, v[n], root) for n, sub in s.get("properties", {}).items() if n in v)
        ok &= all(fits(sub, x, root) for p, sub in s.get("patternProperties", {}).items() for n, x in v.items() if re.search(p, n))
        free = [x for n, x in v.items() if n not in s.get("properties", {}) and not any(re.search(p, n) for p in s.get("patternProperties", {}))]
        ok &= all(fits(s.get("additionalProperties", True), x, root) for x in free)
    if k == "array":
        head = s.get("prefixItems", [])
        ok &= all(fits(sub, x, root) for sub, x in zip(head, v, strict=False)) and all(fits(s.get("items", True), x, root) for x in v[len(head):])
        ok &= s.get("minItems", 0) <= len(v) <= s.get("maxItems", 99) and (not s.get("uniqueItems") or len({json.dumps(x) for x in v}) == len(v))
        ok &= "contains" not in s or any(fits(s["contains"], x, root) for x in v)
    ok &= all(fits(x, v, root) for x in s.get("allOf", ())) and ("anyOf" not in s or any(fits(x, v, root) for x in s["anyOf"]))
    ok &= "oneOf" not in s or sum(fits(x, v, root) for x in s["oneOf"]) == 1
    ok &= "not" not in s or not fits(s["not"], v, root)
    if "if" in s:
        ok &= fits(s.get("then" if fits(s["if"], v, root) else "else", True), v, root)
    return bool(ok)


def value(rng, depth=3):
    kinds = [lambda: None, lambda: rng.random() < 0.5, lambda: rng.randint(-3, 6), lambda: rng.randint(-6, 12) / 2, lambda: rng.choice(["", "a", "ab", "xyz", "é", "2020-02-29", "2021-02-29", "2021-01-31"])]
    if depth:
        kinds += [lambda: [value(rng, depth - 1) for _ in range(rng.randint(0, 3))], lambda: {n: value(rng, depth - 1) for n in rng.sample(["a", "b", "x:y", "x~/"], rng.randint(0, 4))}] * 2
    return rng.choice(kinds)()


def made(rng, depth=2):
    leaf = [
        lambda: {"type": rng.choice(["integer", "number", "string", "object", "array", "null", ["boolean", "string"]])}, lambda: {"const": value(rng, 1)}, lambda: {"enum": [value(rng, 0) for _ in range(3)]},
        lambda: {"minLength": 1, "maxLength": 2}, lambda: {"pattern": rng.choice(["^a", "b$", "[x-z]"])}, lambda: {"format": "date"}, lambda: {"minimum": 0, "exclusiveMinimum": -1, "maximum": 3}, lambda: {"multipleOf": 1.5}, lambda: {"$ref": "#/$defs/small"}, lambda: rng.random() < 0.7,
    ]
    if not depth:
        return rng.choice(leaf)()
    sub = lambda: made(rng, depth - 1)
    nested = [
        lambda: {"properties": {"a": sub(), "x:y": sub(), "x~/": sub()}, "required": rng.sample(["a", "b"], 1)}, lambda: {"properties": {"a": True}, "patternProperties": {"^x": sub()}, "additionalProperties": sub()}, lambda: {"minProperties": 1, "additionalProperties": sub()},
        lambda: {"items": sub(), "minItems": 1}, lambda: {"prefixItems": [sub(), sub()], "items": sub(), "maxItems": 2}, lambda: {"contains": sub(), "uniqueItems": True},
        lambda: {"allOf": [sub(), sub()]}, lambda: {"anyOf": [sub(), sub()]}, lambda: {"oneOf": [sub(), sub(), sub()]}, lambda: {"not": sub()}, lambda: {"if": sub(), "then": sub(), "else": sub()},
    ]
    return rng.choice(nested)()


@pytest.mark.parametrize("seed", [1, 2])
def test_against_a_plain_evaluator(spark, seed):
    rng = random.Random(seed)
    values = [value(rng) for _ in range(120)]
    schemas = [{"$defs": {"small": {"type": "integer", "maximum": 2}}, **(m if isinstance(m := made(rng), dict) else {})} for _ in range(14)]
    rows = spark.createDataFrame([(k, json.dumps(v)) for k, v in enumerate(values)], "k int, body string").withColumn("v", F.explode(F.array(F.try_parse_json(F.col("body")))))
    found = rows.select("k", *[(F.size(jsonschema.compile_schema(s, F.col("v"))) == 0).alias(f"s{i}") for i, s in enumerate(schemas)]).collect()
    wrong = [(schemas[i], values[r["k"]]) for r in found for i in range(len(schemas)) if r[f"s{i}"] != fits(schemas[i], values[r["k"]], schemas[i])]
    assert not wrong
    assert any(not r[f"s{i}"] for r in found for i in range(len(schemas)))


def errors(spark, schema, *bodies, **options):
    rows = spark.createDataFrame([(k, b) for k, b in enumerate(bodies)], "k int, body string")
    return [[tuple(e) for e in r["errors"]] for r in jsonschema.with_errors(rows, schema, **options).orderBy("k").collect()]


def test_paths_and_broken_documents(spark):
    schema = {"type": "object", "properties": {"a": {"items": {"properties": {"x~/": {"type": "string"}}}}, "b": False}, "additionalProperties": {"minimum": 1}, "required": ["a"]}
    bodies = ('{"a":[{},{"x~/":1}],"b":2,"c":0}', None, "{bad", '{"a":1,"a":2}', "3", '{"a":null}', "")
    assert errors(spark, schema, *bodies) == [[("/a/1/x~0~1", "type"), ("/b", "false"), ("/c", "minimum")], [("", "missing")], [("", "json")], [("", "json")], [("", "type")], [], [("", "json")]]
    assert errors(spark, True, "1", None) == [[], [("", "missing")]] and errors(spark, False, "1") == [[("", "false")]]


def test_references(spark):
    other = {"definitions": {"id": {"type": "string", "minLength": 2}}, "properties": {"id": {"$ref": "#/definitions/id"}}}
    assert errors(spark, {"$ref": "https://example.org/item.json"}, '{"id":"a"}', '{"id":"ab"}', documents={"https://example.org/item.json": other}) == [[("/id", "minLength")], []]
    with pytest.raises(ValueError, match="back to itself"):
        jsonschema.compile_schema({"properties": {"next": {"$ref": "#"}}}, F.lit(None))


def test_formats_and_report(spark):
    schema = {"properties": {"t": {"format": "date-time"}, "u": {"format": "uri"}, "i": {"format": "ipv4"}, "n": {"format": "unheard-of"}}}
    good = '{"t":"2020-02-29T23:59:60.5+01:00","u":"https://example.org/a?b","i":"192.0.2.1","n":"x"}'
    bad = '{"t":"2021-02-29T00:00:00Z","u":"no scheme","i":"256.1.1.1","n":1}'
    assert errors(spark, schema, good, bad) == [[], [("/t", "format"), ("/u", "format"), ("/i", "format")]]
    rows = spark.createDataFrame([("d/a.json", good), ("d/b.json", bad), ("d/c.json", None), ("d/e.json", "{")], "item_path string, body string")
    found = [tuple(r) for r in jsonschema.report(rows, schema, "now").orderBy("item_path").collect()]
    assert found[:3] == [("d/a.json", "a", True, True, None, "now"), ("d/b.json", "b", True, False, "Schema validation error: /t format", "now"), ("d/c.json", "c", False, False, "File not found", "now")]
    assert found[3][4].startswith("JSON decode error")


def test_expressions_grow_with_the_schema(spark):
    """Not with a power of its depth: values are computed once."""

    def nested(depth):
        return {"type": "object", "required": ["a"], "properties": {"a": nested(depth - 1) if depth else {"type": "string", "minLength": 1}}}

    length = lambda depth: len(str(jsonschema.compile_schema(nested(depth), F.col("v"))))
    assert length(6) < 4 * length(3)
    text = '{"a":' * 4 + '""' + "}" * 4
    rows = jsonschema.with_errors(spark.createDataFrame([(text,), ('{"a":{"a":3}}',)], "body string"), nested(3)).collect()
    assert [[tuple(e) for e in r["errors"]] for r in rows] == [[("/a/a/a/a", "minLength")], [("/a/a", "type")]]

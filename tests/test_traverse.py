"""Traversal of linked documents, and the addresses of links."""

import json
from urllib.parse import urldefrag, urljoin

from orolith.functions.urls import resolve_href
from orolith.operators import traverse
from pyspark.sql import functions as F

SITE = "https://a.example.org/x/y"


def test_addresses_are_those_of_the_standard_library(spark):
    bases = [f"{SITE}/catalog.json", "https://a.example.org/catalog.json", "s3://bucket/k/c.json", "file:///data/c.json"]
    links = ["a.json", "./a.json", "../a.json", "../../b/./c/../a.json", "/a.json", "//b.example.org/a.json", "https://c.example.org/d/a.json", "a/b/", "a.json#part", "a.json?v=1", "..", ".", "a/.."]
    rows = [(b, x) for b in bases for x in links if not (b.startswith("s3") and x.startswith("//"))]
    got = spark.createDataFrame(rows, "base string, href string").withColumn("full", resolve_href(F.col("base"), F.col("href"))).collect()
    for r in got:  # urljoin knows no s3, and drops the empty host of files
        scheme, rest = r["base"].split("://")
        wanted = urldefrag(urljoin(f"https://{'none' if scheme == 'file' else ''}{rest}", r["href"]))[0]
        if not r["href"].startswith("https"):
            wanted = scheme + wanted.replace("://none/", ":///")[5:]
        assert r["full"] == wanted, r
    odd = spark.createDataFrame([(None, "a"), (SITE, None), (SITE, ""), (SITE, " ")], "base string, href string")
    assert [r[0] for r in odd.select(resolve_href(F.col("base"), F.col("href"))).collect()] == [None] * 4


def body(*links):
    return json.dumps({"type": "Catalog", "links": [{"rel": rel, "href": href, "title": "t"} for rel, href in links]})


def test_cycles_end_and_the_least_depth_counts(spark, tmp_path):
    docs = [
        (f"{SITE}/catalog.json", body(("child", "a/c.json"), ("child", "b/c.json"), ("self", "catalog.json"))),
        (f"{SITE}/a/c.json", body(("child", "../b/c.json"), ("child", "c.json"), ("child", "deep.json"), ("item", "i.json"), ("item", "i.json"))),
        (f"{SITE}/b/c.json", body(("child", "../catalog.json"), ("item", "../a/i.json"), ("child", "lost.json"), ("child", None))),
        (f"{SITE}/a/deep.json", "not json"), (f"{SITE}/alone.json", body(("item", "z.json"))), (f"{SITE}/null.json", None),
    ]
    documents = spark.createDataFrame(docs, "href string, body string")
    roots = spark.createDataFrame([(f"{SITE}/catalog.json",), (f"{SITE}/catalog.json",), (None,)], "href string")
    nodes, links = traverse.traverse(traverse.document_links(documents), roots, str(tmp_path / "one"))
    short = lambda rows: sorted(tuple(x.removeprefix(f"{SITE}/") if isinstance(x, str) else x for x in r) for r in rows.collect())
    assert short(nodes) == [("a/c.json", 1), ("a/deep.json", 2), ("b/c.json", 1), ("b/lost.json", 2), ("catalog.json", 0)]
    assert short(traverse.items_below(nodes, links)) == [("a/i.json", "a/c.json", 2), ("a/i.json", "b/c.json", 2)]
    assert short(traverse.back_links(nodes, links)) == [("a/c.json", "a/c.json"), ("a/c.json", "b/c.json"), ("b/c.json", "catalog.json")]
    assert short(traverse.dangling(nodes, documents)) == [("b/lost.json", 2)]
    nodes, links = traverse.traverse(traverse.document_links(documents.limit(0)), roots.limit(0), str(tmp_path / "none"))
    assert nodes.count() == 0 and traverse.items_below(nodes, links).count() == 0


def test_links_resolve_once_and_as_the_expression_does(spark):
    """F16, F17: the filter on addresses computed them again, and each step of one several times."""
    bases = [f"{SITE}/catalog.json", "https://a.example.org", "s3://bucket/k/c.json", "plain/c.json", "https://a/b/../c/./d?x=/../y#z", "mailto:x", "", None]
    words = ["a", ".", "..", "", "...", "?q=../x", "#f", "http:", "x:y", " "]
    links = [None, "//b.example.org/../a", *words, *(f"{a}/{b}" for a in words for b in words), *(f"../{a}/../{b}" for a in words for b in words)]
    rows = spark.createDataFrame([(b, "item", x) for b in bases for x in links], "source string, rel string, href string")
    wanted = rows.select("source", "rel", resolve_href(F.col("source"), F.col("href")).alias("target")).where("target IS NOT NULL")
    got = traverse.resolved_links(rows)
    assert sorted(map(repr, got.collect())) == sorted(map(repr, wanted.collect()))
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("aggregate(") == 1

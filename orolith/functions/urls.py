"""URLs, identifiers and names as column expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orolith import schema


def fix_scheme(url: Column) -> Column:
    """A single slash after https: becomes two; anything else stays."""
    return F.regexp_replace(url, r"^https:/(?!/)", "https://")


def encode_spaces(url: Column) -> Column:
    """Only spaces are encoded."""
    return F.replace(url, F.lit(" "), F.lit("%20"))


def item_id(url: Column, source: str = schema.SOURCE) -> Column:
    """Drops as many characters as source has, leading slashes, and one trailing .tif; slashes become dashes.

    The prefix isn't compared, so URLs with a single slash after the scheme give the same id.
    """
    rest = F.regexp_replace(F.substring(url, len(source) + 1, 1 << 30), "^/+", "")
    return F.regexp_replace(F.replace(rest, F.lit("/"), F.lit("-")), r"\.tif$", "")


def url_from_id(identifier: Column, source: str = schema.SOURCE) -> Column:
    """The lossy inverse of item_id: every dash becomes a slash, also those the path had."""
    return F.concat(F.lit(source.rstrip("/") + "/"), F.replace(identifier, F.lit("-"), F.lit("/")), F.lit(".tif"))


def reader_path(url: Column) -> Column:
    """The path by which raster readers open a URL."""
    return F.concat(F.lit("/vsicurl/"), encode_spaces(fix_scheme(url)))


def stem(path: Column) -> Column:
    """A file's name without its last suffix."""
    name = F.regexp_extract(path, r"([^/]*)$", 1)
    return F.regexp_replace(name, r"(?<=.)\.[^.]*$", "")


def published_href(identifier: Column, base: str = schema.PUBLISHED) -> Column:
    return F.concat(F.lit(base + "/"), identifier, F.lit(".json"))


#: A scheme, and the site and path of an address.
_SCHEME = "^[a-zA-Z][a-zA-Z0-9+.-]*:"
_SPLIT = r"^([a-zA-Z][a-zA-Z0-9+.-]*:(?://[^/?#]*)?)/?([^?#]*)"


def _segments(path: Column) -> Column:
    """The segments of a path without its first slash, . and .. applied; those that lead above the top are dropped."""
    none = F.array().cast("array<string>")
    return F.aggregate(F.split(path, "/"), none, lambda held, x: F.when(x == ".", held).when(x == "..", F.slice(held, 1, F.greatest(F.size(held) - 1, F.lit(0)))).otherwise(F.array_append(held, x)))


def _link(href: Column) -> Column:
    return F.regexp_replace(F.trim(href), "#.*$", "")


def _below(path: Column, own: Column) -> Column:
    """A link's path from the top of its site, before dots are applied; own: the path of the document it is in."""
    return F.when(F.startswith(path, F.lit("/")), F.substring(path, 2, 1 << 30)).when(path == "", own).otherwise(F.concat(F.regexp_replace(own, "[^/]*$", ""), path))


def _undotted(below: Column, parts: Column) -> Column:
    """A path put together from its segments."""
    return F.concat(F.array_join(parts, "/"), F.when(below.rlike(r"(^|/)\.\.?$") & (F.size(parts) > 0), "/").otherwise(""))


def resolve_href(base: Column, href: Column) -> Column:
    """A link's full address, given that of the document it is in; null where either is, or where the link is empty. Fragments go."""
    link = _link(href)
    site, own = (F.regexp_extract(base, _SPLIT, k) for k in (1, 2))
    joined = F.when(link.rlike(_SCHEME), link).when(F.startswith(link, F.lit("//")), F.concat(F.regexp_extract(base, "^([^:]*:)", 1), link))
    below = _below(F.regexp_replace(link, r"\?.*$", ""), own)
    return F.when(F.length(link) > 0, F.coalesce(joined, F.concat(site, F.lit("/"), _undotted(below, _segments(below)), F.regexp_extract(link, r"(\?.*)$", 1))))


def add_target(links: DataFrame, base: str, href: str, name: str) -> DataFrame:
    """resolve_href() as a column of the rows for which it isn't null.

    Step by step in columns, so that each is computed once; rows go by the link itself, since a filter on the
    address would compute all of it again. Links in full, and paths without dots, skip the steps that change nothing in them.
    """
    kept, got = links.columns, lambda part: F.col(f"_t_{part}")
    rows = links.withColumn("_t_link", _link(F.col(href))).where((F.length(got("link")) > 0) & (F.col(base).isNotNull() | got("link").rlike(_SCHEME)))
    rows = rows.withColumn("_t_full", got("link").rlike(_SCHEME))
    asked = F.contains(got("link"), F.lit("?"))
    rows = rows.withColumns({
        "_t_path": F.when(~got("full"), F.when(asked, F.regexp_replace(got("link"), r"\?.*$", "")).otherwise(got("link"))),
        "_t_query": F.when(~got("full"), F.when(asked, F.regexp_extract(got("link"), r"(\?.*)$", 1)).otherwise("")),
        **{f"_t_{part}": F.when(~got("full"), F.regexp_extract(F.col(base), _SPLIT, k)) for k, part in ((1, "site"), (2, "own"))},
    })
    rows = rows.withColumn("_t_below", _below(got("path"), got("own")))
    rows = rows.withColumn("_t_parts", F.when(got("below").rlike(r"(^|/)\.\.?(/|$)"), _segments(got("below"))))
    path = F.when(got("parts").isNull(), got("below")).otherwise(_undotted(got("below"), got("parts")))
    beside = F.concat(F.regexp_extract(F.col(base), "^([^:]*:)", 1), got("link"))
    target = F.when(got("full"), got("link")).when(F.startswith(got("link"), F.lit("//")), beside).otherwise(F.concat(got("site"), F.lit("/"), path, got("query")))
    return rows.select(*[c for c in kept if c != name], target.alias(name))


def strip_slash(path: Column) -> Column:
    """Takes off one trailing slash."""
    return F.regexp_replace(path, "/$", "")


def is_raster_name(url: Column) -> Column:
    """The listing's pattern: contains dem, ends in .tif."""
    return F.contains(url, F.lit("dem")) & F.endswith(url, F.lit(".tif"))


def has_parenthesis(url: Column) -> Column:
    return F.contains(url, F.lit("("))


def media_type(is_cog: Column) -> Column:
    return F.when(is_cog, schema.MEDIA_TYPE_COG).otherwise(schema.MEDIA_TYPE)


def log_name(at: Column, description: str, suffix: str = "log") -> Column:
    return F.concat(F.date_format(at, "yyyyMMdd_HHmmss"), F.lit(f"_{description}.{suffix}"))


def error_text(kind: str, message: Column) -> Column:
    """A kind, then the first 100 characters of the message."""
    return F.concat(F.lit(kind + ": "), F.substring(message, 1, 100))

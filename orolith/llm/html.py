"""Main text of web pages by equivalence-class template deduction.

Tokens of a page are its elements, told apart by the path of tags, classes and ids around
them, and its text blocks with theirs. Over the pages of a host, tokens with the same
occurrence vector (how often each page has them) form an equivalence class. Vectors aren't
gathered: a token's vector is summed up by an exclusive-or of hashes of (page, times),
which partial aggregation combines, so a host with a third of all pages is no task of its
own. A class is valid if it has an element and is on two pages at least and on a share of
SUPPORT of the host's; so hosts with several layouts have classes for each. Valid classes
nest: a class lies in the class of the element around its outermost one. They are the
host's template; a text block in a valid class is fixed text of the template.

What an element of the template holds beside template elements and fixed text is a slot.
From a page's outermost element on, the slot that holds the article is sought: the walk goes down
into the nested element that holds over half of the slot text of the one around it (half is enough for
an article or main element), summed over the host's pages that have it, and ends where none does, where a main heading (h1)
would be left behind, or in an article element. Elements that come more than once on a page
and those of running text (paragraphs, lists, headings) aren't gone into. The text of that slot is taken whole,
whatever pages share of it: what pages of a host agree on there may be copies of one article.

Names are a second test: text enclosed by an element whose name, role or class says menu,
header, footer, sidebar, notice, advert, form or reader comments isn't slot text at any step.
A page that no template of its host fits (a lone page of its host, a layout of fewer pages, copies only, where no
text is left to tell slots by) is walked down by its own text in the same way.

Defined results: null or empty html has an empty text; a null or odd url has the host
'' ; unclosed and cut-off markup ends with the page; repeated rows are pages of their
own; an empty table gives no rows; other columns pass through.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialize

#: A class is valid on so large a share of a host's pages, and on two at least. So a host's template has at most a page's tokens, divided by it.
SUPPORT = 0.1
RAW = {"script", "style", "template", "iframe", "textarea", "title"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"}
INLINE = {"a", "abbr", "b", "bdi", "bdo", "big", "cite", "code", "data", "del", "dfn", "em", "font", "i", "ins", "kbd", "label", "mark", "q", "s", "samp", "small", "span", "strike", "strong", "sub", "sup", "time", "tt", "u", "var", "wbr", "img"}
#: Elements of running text, which are no part of a page's layout.
RUNNING = {"p", "h1", "h2", "h3", "h4", "h5", "h6", "li", "ul", "ol", "dl", "dt", "dd", "blockquote", "pre", "figure", "figcaption", "noscript", "svg", "math", "object"}
AROUND = {"nav", "footer", "aside", "form", "head", "menu", "dialog", "button", "select", "fieldset", "datalist"}
ROLES = {"navigation", "banner", "contentinfo", "complementary", "search", "form", "dialog", "alertdialog", "alert", "menu", "menubar"}
#: Words of class and id names of what isn't the article, wherever it is.
CERTAIN = {"ad", "ads", "advert", "adverts", "advertisement", "advertising", "comment", "comments", "consent", "cookie", "cookies", "disqus", "gdpr", "navbar", "newsletter", "sidebar", "skyscraper", "sponsor", "sponsored", "subscribe"}
#: Such as mean it outside of an article element, and inside where all words are of either kind.
LIKELY = {"banner", "breadcrumb", "breadcrumbs", "footer", "header", "masthead", "menu", "modal", "nav", "navigation", "notice", "notices", "pager", "pagination", "popup", "promo", "promotion", "related", "replies", "respond", "share", "sharing", "signup", "social", "toolbar", "widget"}
TAG = re.compile(r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:=\s*+(?:\"[^\"]*\"|'[^']*'|[^\s\"'>][^\s>]*)|[^>])*+)(?:>|\Z)", re.S)
ATTRIBUTE = re.compile(r"([^\s=/\"'>]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?")
DIGITS = re.compile(r"\d{2,}")  # numbers in names tell pages apart, not elements
WORDS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")


def _attributes(text: str) -> dict[str, str]:
    return {m[1].lower(): html.unescape(m[2] or m[3] or m[4] or "") for m in ATTRIBUTE.finditer(text)}


def _outside(name: str, attributes: dict[str, str], in_article: bool) -> bool:
    """Whether an element's name, role or class says that it holds no main text."""
    if name in AROUND or name == "header" and not in_article or attributes.get("role", "").lower() in ROLES or "hidden" in attributes:
        return True
    if name in ("body", "html", "article", "main"):
        return False
    words = {w.lower() for key in ("class", "id") for w in WORDS.findall(attributes.get(key, ""))}
    if in_article and attributes.get("id", "").lower() == "related":
        return False
    if in_article or name in RUNNING:  # an article may speak of such things
        return bool(words) and words <= CERTAIN | LIKELY - {"header"} or name not in RUNNING and bool(words & CERTAIN)
    return bool(words & (CERTAIN | LIKELY))


def _hash(*parts: str) -> int:
    return xxhash.xxh64_intdigest("\0".join(parts).encode("utf-8", "surrogatepass")) - (1 << 63)


def parse(page: str | None) -> tuple[list[tuple[str, str, int, bool]], list[tuple[int, str, bool]]]:
    """Elements (path, name, number of the one around, outside) and text blocks (number of the element, text, outside), both in page order.

    Element 0 is the page. Inline elements are none.
    """
    elements: list[tuple[str, str, int, bool]] = [("", "", 0, False)]
    blocks: list[tuple[int, str, bool]] = []
    stack: list[tuple[str, int, bool, bool]] = [("", 0, False, False)]  # name, element, outside, in an article
    run: list[str] = []
    page = page or ""

    def flush() -> None:
        text = " ".join("".join(run).split())
        run.clear()
        if text:
            blocks.append((stack[-1][1], text, stack[-1][2]))

    at = 0
    while at < len(page):
        m = TAG.search(page, at)
        if not m:
            run.append(html.unescape(page[at:]))
            break
        if m.start() > at:
            run.append(html.unescape(page[at: m.start()]))
        at = m.end()
        if not m[2]:
            if m[0].startswith("<![CDATA["):
                run.append(m[0][9:].removesuffix("]]>"))
            continue
        name = m[2].lower()
        if name not in INLINE:
            flush()
        if m[1]:
            for k in range(len(stack) - 1, 0, -1):
                if stack[k][0] == name:
                    if name in INLINE and any(x[0] not in INLINE for x in stack[k + 1:]):
                        break
                    if any(x[0] not in INLINE for x in stack[k:]) or stack[k][2] != stack[k - 1][2]:
                        flush()
                    del stack[k:]
                    break
            continue
        if name in RAW:
            end = re.compile(rf"</{re.escape(name)}\s*>", re.I).search(page, at)
            at = end.end() if end else len(page)
            continue
        if name in VOID or m[3].endswith("/") and name not in INLINE and name not in ("p", "div"):
            continue
        attributes = _attributes(m[3]) if m[3].strip() else {}
        if name in ("p", "li", "dt", "dd", "option", "tr", "td", "th"):  # a next one ends the one before
            for k in range(len(stack) - 1, 0, -1):
                if stack[k][0] == name:
                    del stack[k:]
                    break
                if stack[k][0] not in INLINE and stack[k][0] != "p":
                    break
        _, around, out, article = stack[-1]
        opens = _outside(name, attributes, article)
        if name in INLINE:
            if opens and not out:
                flush()
            number = around
        else:
            number = len(elements)
            marks = "".join(f"{sign}{DIGITS.sub('0', attributes[key])}" for key, sign in (("class", "."), ("id", "#")) if attributes.get(key))
            path = f"{elements[around][0]}/{name}{marks}"
            elements.append((path, name, around, out or opens))
        stack.append((name, number, out or opens, article or name in ("article", "main")))
    flush()
    return elements, blocks


class Layout:
    """A page's layout: elements that come once, by themselves or among the host's template elements, and the slot text in each."""

    def __init__(self, page: str | None, known: set[int] | None, fixed: set[int]):
        self.elements, self.blocks = parse(page)
        self.tokens = [_hash(e[0]) for e in self.elements]
        times = Counter(self.tokens)
        n = len(self.elements)
        self.inside, self.heads = [0] * n, [0] * n
        for e, text, out in self.blocks:
            if not out and (not fixed or _hash(self.elements[e][0], text) not in fixed):
                self.inside[e] += len(text)
                self.heads[e] += self.elements[e][1] == "h1"
        for k in range(n - 1, 0, -1):
            self.inside[self.elements[k][2]] += self.inside[k]
            self.heads[self.elements[k][2]] += self.heads[k]
        self.up = [0] * n  # the layout element around each element
        self.chosen: list[int] = []
        own = [True] + [False] * (n - 1)
        for k in range(1, n):
            _, name, around, out = self.elements[k]
            self.up[k] = around if own[around] else self.up[around]
            own[k] = not out and name not in RUNNING and times[self.tokens[k]] == 1 and (known is None or self.tokens[k] in known)
            if own[k]:
                self.chosen.append(k)

    def named(self, k: int) -> bool:
        return self.elements[k][1] in ("article", "main")

    def main_slot(self, main: set[int] | None) -> int:
        """The element that the walk ends in; main: the host's elements to go into, None to go by the page's own text."""
        now = 0
        while self.elements[now][1] != "article":
            inner = [k for k in self.chosen if self.up[k] == now and (2 * self.inside[k] + self.named(k) > self.inside[now] if main is None else self.tokens[k] in main)]
            if not inner:
                break
            best = max(inner, key=lambda k: self.inside[k])
            if self.heads[best] < self.heads[now]:
                break
            now = best
        return now

    def text_in(self, slot: int) -> str:
        within = [False] * len(self.elements)
        within[slot] = True
        for k in range(1, len(within)):
            within[k] |= within[self.elements[k][2]]
        return " ".join(text for e, text, out in self.blocks if within[e] and not out)


def main_text(page: str | None, known: set[int], main: set[int]) -> str:
    """The main text of a page, given its host's template elements and those of them to go into."""
    if main:
        layout = Layout(page, known, set())
        if slot := layout.main_slot(main):
            return layout.text_in(slot)
    layout = Layout(page, None, set())
    return layout.text_in(layout.main_slot(None))


def host_of(url: F.Column) -> F.Column:
    return F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), r"^[a-zA-Z][a-zA-Z0-9+.-]*://([^/?#]*)", 1))


def token_vectors(pages: DataFrame) -> DataFrame:
    """Tokens of hosts: (host, token long, around, path, is_text, pages, most, vector); the token of path '' counts the host's pages.

    around is the token of the element around; most: times on a page at most. vector is the exclusive-or over
    pages of a hash of (page, times): equal occurrence vectors have equal ones.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        page = TaskContext.get().partitionId() << 33
        for b in batches:
            found: dict[tuple[str, int], list] = {}
            for host, text in zip(b.column("host").to_pylist(), b.column("html").to_pylist(), strict=True):
                elements, blocks = parse(text)
                tokens = [_hash(e[0]) for e in elements]
                times = Counter((t, tokens[e[2]], e[0], False) for t, e in zip(tokens, elements, strict=True))
                times.update((_hash(elements[e][0], block), tokens[e], elements[e][0], True) for e, block, _ in blocks)
                for (token, around, path, is_text), n in times.items():
                    x = found.setdefault((host, token), [around, path, is_text, 0, 0, 0])
                    x[3] += 1
                    x[4] = max(x[4], n)
                    x[5] ^= _hash(str(page), str(n))
                page += 1
            keys, values = list(found), list(found.values())
            kinds = (pa.int64(), pa.string(), pa.bool_(), pa.int64(), pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array([k[0] for k in keys], pa.string()), pa.array([k[1] for k in keys], pa.int64()), *(pa.array([v[i] for v in values], t) for i, t in enumerate(kinds))], ["host", "token", "around", "path", "is_text", "pages", "most", "vector"])

    parts = pages.select(host_of(F.col("url")).alias("host"), "html").mapInArrow(run, "host string, token long, around long, path string, is_text boolean, pages long, most long, vector long")
    return parts.groupBy("host", "token").agg(F.min("around").alias("around"), F.min("path").alias("path"), F.max("is_text").alias("is_text"), F.sum("pages").alias("pages"), F.max("most").alias("most"), F.bit_xor("vector").alias("vector"))


def deduce_templates(pages: DataFrame) -> DataFrame:
    """Valid classes of each host: (host, class, path, parent, pages, most, elements, texts).

    class names the occurrence vector; elements and texts are its tokens. path is of its outermost element, parent the
    class this one nests in, null for the one of the page itself.
    """
    tokens = token_vectors(pages).where("pages > 1 OR path = ''")
    tokens = materialize(tokens, "tokens")
    hosts = tokens.where("path = '' AND NOT is_text").select(F.col("host").alias("_h"), F.col("pages").alias("all_pages"))
    often = tokens.join(hosts, F.col("host") == F.col("_h")).where((F.col("pages") > 1) & (F.col("pages") >= F.col("all_pages") * SUPPORT))
    outermost = F.min(F.when(~F.col("is_text"), F.struct(F.length("path").alias("n"), "path", "around")))
    classes = often.groupBy("host", F.col("vector").alias("class")).agg(
        F.max("pages").alias("pages"), F.max("most").alias("most"), outermost.alias("top"),
        F.sort_array(F.collect_set(F.when(~F.col("is_text"), F.col("token")))).alias("elements"), F.sort_array(F.collect_set(F.when(F.col("is_text"), F.col("token")))).alias("texts"),
    ).where("top IS NOT NULL")
    classes = materialize(classes.select("host", "class", "pages", "most", "top.path", "top.around", "elements", "texts"), "classes")
    holders = classes.select(F.col("host").alias("_h"), F.col("class").alias("_c"), F.explode("elements").alias("_t"))
    nested = classes.join(holders, (F.col("host") == F.col("_h")) & (F.col("around") == F.col("_t")), "left")
    return nested.select("host", "class", "path", F.when(F.col("_c") != F.col("class"), F.col("_c")).alias("parent"), "pages", "most", "elements", "texts")


def _with_template(pages: DataFrame, template: DataFrame, *columns: str) -> DataFrame:
    """pages with the columns of a template by host, which get a leading underscore."""
    held = template.select(F.col("host").alias("_host"), *(F.col(c).alias(f"_{c}") for c in columns))
    return pages.drop("_page_host", "_host", *(f"_{c}" for c in columns)).withColumn("_page_host", host_of(F.col("url"))).join(held, F.col("_page_host") == F.col("_host"), "left").drop("_host")


def main_elements(pages: DataFrame) -> DataFrame:
    """Of each host with a template: its elements that come once a page (known), and those of them that hold over half of the slot text around (main)."""
    classes = deduce_templates(pages)
    template = classes.groupBy("host").agg(F.flatten(F.collect_list(F.when(F.col("most") == 1, F.col("elements")))).alias("known"), F.flatten(F.collect_list("texts")).alias("fixed"))
    template = materialize(template, "templates")

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            sums: dict[tuple[str, int], list[int]] = {}
            for host, page, known, fixed in zip(*(b.column(c).to_pylist() for c in ("_page_host", "html", "_known", "_fixed")), strict=True):
                layout = Layout(page, set(known), set(fixed))
                for k in layout.chosen:
                    x = sums.setdefault((host, layout.tokens[k]), [0, 0, int(layout.named(k))])
                    x[0] += layout.inside[k]
                    x[1] += layout.inside[layout.up[k]]
            yield pa.RecordBatch.from_arrays([pa.array([k[0] for k in sums], pa.string()), pa.array([k[1] for k in sums], pa.int64()), *(pa.array([v[i] for v in sums.values()], pa.int64()) for i in (0, 1, 2))], ["host", "token", "inside", "around", "named"])

    joined = _with_template(pages.select("url", "html"), template, "known", "fixed").where("_known IS NOT NULL").select("_page_host", "html", "_known", "_fixed")
    weights = joined.mapInArrow(weigh, "host string, token long, inside long, around long, named long").groupBy("host", "token").agg(F.sum("inside").alias("inside"), F.sum("around").alias("around"), F.max("named").alias("named"))
    main = weights.where("2 * inside + named > around").groupBy(F.col("host").alias("_h")).agg(F.collect_list("token").alias("main"))
    return materialize(template.join(main, F.col("host") == F.col("_h")).select("host", "known", "main"), "main")


def extract_text(pages: DataFrame) -> DataFrame:
    """Adds text and n_chars (code points) to (url, html, ...), whose html goes."""
    joined = _with_template(pages.drop("text", "n_chars"), main_elements(pages), "known", "main").drop("_page_host")
    rest = [f for f in joined.schema.fields if f.name not in ("html", "_known", "_main")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = [main_text(page, set(known or ()), set(main or ())) for page, known, main in zip(*(b.column(c).to_pylist() for c in ("html", "_known", "_main")), strict=True)]
            yield pa.RecordBatch.from_arrays([b.column(f.name) for f in rest] + [pa.array(texts, pa.string()), pa.array(list(map(len, texts)), pa.int64())], [*(f.name for f in rest), "text", "n_chars"])

    return joined.mapInArrow(run, ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rest) + ", text string, n_chars long")

"""SimHash near-duplicates by a Gray-order hierarchical index.

Fingerprints: bit i is set where over half of a text's shingles have it in their
XXH64. Texts link at few differing bits, and a group is what links connect.

Equal fingerprints collapse first, so a group of copies is one entry however large.
The distinct fingerprints are sorted by Gray rank, cut into blocks at quantiles of the
rank, and each pair of blocks meets in one task. There a hierarchical index stands on
each block: a leaf holds neighbours in Gray order, and a node holds the bits that all
below it share (a mask and their pattern). Two nodes whose patterns differ in more than
the allowed bits under their common mask are passed over with all pairs below them;
surviving leaves are compared bit by bit. A task returns a spanning forest of its links.

Defined results: a text without words (null, empty, blank) has fingerprint zero and links
like any other; fewer words than a shingle make one shingle; repeated rows join the same
group; a null id keeps its row, and groups take the least id that isn't null; an empty
table gives no rows; other columns aren't read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import components, forest, materialize

FANOUT = 16
#: Node pairs looked at in one step of a join, which bounds a task's memory.
STEP = 1 << 11


def fingerprint(text: str | None, words: int) -> int:
    """The 64-bit SimHash of a whole text over shingles of so many words."""
    return int(sketch(text, words, 0)[0])


def shingle_hashes(text: str | None, words: int) -> np.ndarray:
    """The XXH64 of each shingle of a whole text in order: none without words, one with fewer words than a shingle."""
    found = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not found:
        return np.zeros(0, np.uint64)
    joined = b" ".join(found)
    digest = xxhash.xxh64_digest
    if len(found) <= words:
        digests = digest(joined, 42)
    else:
        sizes = np.fromiter(map(len, found), np.int64, len(found))
        ends = np.cumsum(sizes + 1) - 1
        starts = (ends - sizes)[: len(found) - words + 1].tolist()
        digests = b"".join([digest(joined[s:e], 42) for s, e in zip(starts, ends[words - 1:].tolist(), strict=True)])
    return np.frombuffer(digests, ">u8").astype(np.uint64)


def sketch(text: str | None, words: int, more: int, once: bool = False) -> np.ndarray:
    """fingerprint() as uint64, then so many 64-bit SimHashes over further hashes of the same shingles. once: repeated shingles count once."""
    hashes = shingle_hashes(text, words)
    if once:
        hashes = np.unique(hashes)
    out = np.zeros(1 + more, np.uint64)
    if not len(hashes):
        return out
    for k in range(1 + more):
        if k:  # odd multipliers and a shift make further hashes of the first
            hashes = (hashes ^ (hashes >> np.uint64(29))) * np.uint64(0x9E3779B97F4A7C15 + 2 * k)
        counts = np.zeros(64, np.int64)
        for at in range(0, len(hashes), 1 << 15):
            bits = np.unpackbits(hashes[at: at + (1 << 15)].view(np.uint8), bitorder="little").reshape(-1, 64)
            whole = len(bits) // 128 * 128  # sums of 128 bits fit in a byte
            counts += bits[:whole].reshape(-1, 128, 64).sum(1, dtype=np.uint8).sum(0, dtype=np.int64) + bits[whole:].sum(0, dtype=np.uint8)
        out[k] = np.packbits(2 * counts > len(hashes), bitorder="little").view(np.uint64)[0]
    return out


def fingerprints(docs: DataFrame, words: int = 4, text: str = "text", more: int = 0, once: bool = False) -> DataFrame:
    """Adds fp long (the 64 bits, signed) and wide binary (more * 64 bits) in place of the text. once: over distinct shingles."""
    rest = [c for c in docs.columns if c != text]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = [sketch(t, words, more, once) for t in b.column(text).to_pylist()]
            fp, wide = np.array([x[0] for x in found], np.uint64).view(np.int64), [x[1:].tobytes() for x in found]
            yield pa.RecordBatch.from_arrays([b.column(c) for c in rest] + [pa.array(fp, pa.int64()), pa.array(wide, pa.binary())], [*rest, "fp", "wide"])

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields if f.name != text)
    return docs.mapInArrow(run, f"{fields}, fp long, wide binary")


def gray_rank(fp: np.ndarray) -> np.ndarray:
    """The place of each fingerprint in Gray order."""
    rank = fp.copy()
    for shift in (1, 2, 4, 8, 16, 32):
        rank ^= rank >> np.uint64(shift)
    return rank


def build_index(fp: np.ndarray, depth: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """Levels of (mask, pattern) over fingerprints in Gray order: themselves first, one node last.

    Each level is shaped (nodes above, FANOUT); what fills its last row isn't counted by join_blocks.
    """
    low = high = fp
    levels = []
    for level in range(depth + 1):
        if level:
            at = np.arange(0, len(low), FANOUT)
            low, high = np.bitwise_and.reduceat(low, at), np.bitwise_or.reduceat(high, at)
        fill = -len(low) % FANOUT
        levels.append(tuple(np.pad(x, (0, fill)).reshape(-1, FANOUT) for x in (~(low ^ high), low)))
    return levels


def join_blocks(a: np.ndarray, b: np.ndarray, bits: int, same: bool) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Links between fingerprints a and b, each in Gray order, as indices; same: they are one block, and each link comes once."""
    sizes = [(len(a), len(b))]
    while max(sizes[-1]) > 1:
        sizes.append(tuple(-(-x // FANOUT) for x in sizes[-1]))
    index_a, index_b = (build_index(x, len(sizes) - 1) for x in (a, b))
    stack = [(len(sizes), np.zeros(1, np.int64), np.zeros(1, np.int64))]
    while stack:
        level, x, y = stack.pop()
        if len(x) > STEP:
            stack += [(level, x[i: i + STEP], y[i: i + STEP]) for i in range(0, len(x), STEP)]
            continue
        below = level - 1
        (mask_a, low_a), (mask_b, low_b) = index_a[below], index_b[below]
        apart = low_a[x][:, :, None] ^ low_b[y][:, None, :]
        if below:  # fingerprints themselves share all their bits
            apart &= mask_a[x][:, :, None]
            apart &= mask_b[y][:, None, :]
        k, i, j = np.nonzero(np.bitwise_count(apart) <= bits)
        i, j = x[k] * FANOUT + i, y[k] * FANOUT + j
        inside = (i < sizes[below][0]) & (j < sizes[below][1])
        if same:
            inside &= (i <= j) if below else (i < j)
        i, j = i[inside], j[inside]
        if not len(i):
            continue
        if below:
            stack.append((below, i, j))
        else:
            yield i, j


def links_forest(a: np.ndarray, b: np.ndarray, bits: int, bands: tuple[int, int] | None, same: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """A spanning forest (node, node, sure) of the links of two blocks; memory stays within the forest and one step.

    a, b: sketches, a row each, in Gray order of their first column; their last column is the node. Links differ in at most bits of the first column and, with bands (sure, wide), in at most wide
    of all bits between; up to sure bits they need no test. Of the others, which do, those of least difference
    make up the forest where sure links don't connect already.
    """
    held: list[tuple[np.ndarray, ...]] = []
    size = 0

    def reduce() -> list[tuple[np.ndarray, ...]]:
        u, v, apart = (np.concatenate([np.zeros(0, np.int64), *side]) for side in zip(*held, strict=True)) if held else (np.zeros(0, np.int64),) * 3
        sure = apart <= (bands[0] if bands else bits)
        x, y = forest(u[sure], v[sure])
        kept = [(x, y, np.zeros(len(x), np.int64))]
        if not sure.all():
            kept.append(nearest_forest(x, y, u[~sure], v[~sure], apart[~sure]))
        return kept

    for i, j in join_blocks(np.ascontiguousarray(a[:, 0]), np.ascontiguousarray(b[:, 0]), bits, same):
        apart = np.zeros(len(i), np.int64)
        if bands:
            apart = np.bitwise_count(a[i, :-1] ^ b[j, :-1]).sum(1, dtype=np.int64)
            near = apart <= bands[1]
            i, j, apart = i[near], j[near], apart[near]
        held.append((a[i, -1].view(np.int64), b[j, -1].view(np.int64), apart))
        size += len(i)
        if size > 1 << 20:
            held, size = reduce(), 0
    u, v, apart = (np.concatenate(side) for side in zip(*reduce(), strict=True))
    return u, v, apart <= (bands[0] if bands else bits)


def nearest_forest(x: np.ndarray, y: np.ndarray, u: np.ndarray, v: np.ndarray, apart: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of links (u, v, apart) those, by least difference, that connect what the forest (x, y) leaves apart."""
    root = dict(zip(x.tolist(), y.tolist(), strict=True))

    def find(n: int) -> int:
        while (up := root.get(n, n)) != n:
            root[n] = root.get(up, up)
            n = root[n]
        return n

    kept = []
    for k in np.lexsort((v, u, apart)).tolist():
        p, q = find(int(u[k])), find(int(v[k]))
        if p != q:
            root[max(p, q)] = min(p, q)
            kept.append(k)
    return u[kept], v[kept], apart[kept]


def block_bits(pivots: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(mask, pattern) of the bits that all fingerprints of a block share, from the Gray ranks between which it lies, which lack their last bit."""
    low = np.concatenate([np.zeros(1, np.uint64), pivots + np.uint64(1)])
    high = np.concatenate([pivots, np.full(1, (1 << 63) - 1, np.uint64)])
    high = np.maximum(low, high)
    apart = low ^ high
    for shift in (1, 2, 4, 8, 16, 32):
        apart |= apart >> np.uint64(shift)
    mask = ~((apart << np.uint64(1)) | np.uint64(1))
    rank = low << np.uint64(1)
    return mask, (rank ^ (rank >> np.uint64(1))) & mask


def near_links(distinct: DataFrame, bits: int = 4, blocks: int = 16, block_rows: int = 1 << 20, more: int = 0, bands: tuple[int, int] | None = None) -> DataFrame:
    """Links (a, b, sure) between nodes (node, fp, wide) that connect the same nodes as all links do.

    blocks: at least so many blocks, more where one would exceed block_rows fingerprints. Pairs of blocks whose shared bits differ too much don't meet.
    """
    spark = distinct.sparkSession
    total = distinct.count()
    if not total:
        return spark.createDataFrame([], "a long, b long, sure boolean")
    n = max(blocks, -(-total // block_rows))

    def ranked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fp = b.column("fp").to_numpy(zero_copy_only=False).view(np.uint64)
            yield pa.RecordBatch.from_arrays([pa.array((gray_rank(fp) >> np.uint64(1)).astype(np.int64))], ["rank"])

    marks = [i / n for i in range(1, n)]
    pivots = np.array(distinct.select("fp").mapInArrow(ranked, "rank long").agg(F.percentile_approx("rank", marks, 10_000)).first()[0], np.uint64)
    mask, pattern = block_bits(pivots)

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fp, node = (b.column(c).to_numpy(zero_copy_only=False).view(np.uint64) for c in ("fp", "node"))
            sketches = np.column_stack([fp, np.frombuffer(b"".join(b.column("wide").to_pylist()), np.uint64).reshape(len(fp), more), node])
            block = np.searchsorted(pivots, gray_rank(fp) >> np.uint64(1), side="left")
            pair, side, payload = [], [], []
            for k in np.unique(block).tolist():
                part = sketches[block == k].tobytes()
                for other in np.flatnonzero(np.bitwise_count((pattern ^ pattern[k]) & mask & mask[k]) <= bits).tolist():
                    pair.append(min(k, other) * n + max(k, other))
                    side.append(int(k > other))
                    payload.append(part)
            yield pa.RecordBatch.from_arrays([pa.array(pair, pa.int64()), pa.array(side, pa.int32()), pa.array(payload, pa.binary())], ["pair", "side", "payload"])

    def meet(key: tuple, rows: pa.Table) -> pa.Table:
        pair = key[0].as_py()
        same = pair // n == pair % n
        sides = np.array(rows.column("side").to_pylist())
        payload = rows.column("payload").to_pylist()
        a, b = (np.concatenate([np.zeros(0, np.uint64), *(np.frombuffer(payload[i], np.uint64) for i in np.flatnonzero(sides == s))]).reshape(-1, 2 + more) for s in (0, 1))
        a, b = (x[np.argsort(gray_rank(x[:, 0]), kind="stable")] for x in (a, a if same else b))
        u, v, sure = links_forest(a, b, bits, bands, same) if len(a) and len(b) else (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, bool))
        return pa.table({"a": u, "b": v, "sure": sure})

    return distinct.select("node", "fp", "wide").mapInArrow(deal, "pair long, side int, payload binary").repartition(min(n * (n + 1) // 2, 4000), "pair").groupBy("pair").applyInArrow(meet, "a long, b long, sure boolean")


def near_duplicates(docs: DataFrame, bits: int = 4, words: int = 4, blocks: int = 16, more: int = 0, bands: tuple[int, int] | None = None, similarity: float = 0.0) -> DataFrame:
    """Adds fp, component_id (least doc_id of the group) and group (a number for it) to the columns of docs but text.

    With bands (see links_forest), sketches are over distinct shingles, and every link is tested by the Jaccard similarity of these.
    """
    docs = docs.drop("fp", "wide", "component_id", "group", "_fp", "_wide", "_text")
    marked = materialize(fingerprints(docs.withColumn("_text", F.xxhash64("text")), words, more=more, once=bands is not None), "fp")
    distinct = marked.groupBy("fp", "wide").agg(F.min("doc_id").alias("least"), F.min("_text").alias("text_hash"))
    distinct = materialize(distinct.withColumn("node", F.monotonically_increasing_id()), "fps")
    found = materialize(near_links(distinct, bits, blocks, more=more, bands=bands), "links")
    if bands:
        found = materialize(confirm(distinct, found, docs.select(F.xxhash64("text").alias("text_hash"), "text"), words, similarity, bits, bands[1]), "links")
    groups = components(found.select("a", "b")).withColumnRenamed("node", "_node")
    named = distinct.join(groups, F.col("node") == F.col("_node"), "left").select("fp", "wide", "least", F.coalesce("component", "node").alias("root"))
    named = materialize(named, "roots")
    heads = named.groupBy("root").agg(F.min("least").alias("component_id"))
    groups = named.join(heads, "root").select(F.col("fp").alias("_fp"), F.col("wide").alias("_wide"), "component_id", F.col("root").alias("group"))
    return marked.join(groups, (marked["fp"] == groups["_fp"]) & (marked["wide"] == groups["_wide"])).drop("_fp", "_wide", "wide", "_text")


def confirm(distinct: DataFrame, found: DataFrame, texts: DataFrame, words: int, similarity: float, bits: int, wide_bits: int, size: int = 2000) -> DataFrame:
    """Links (a, b) whose texts are similar enough, and which connect all that such links do.

    First the links that sketches are sure of are tested, each by itself; most pass, and connect nearly all of large groups. Those that fail are in doubt like the rest.
    distinct: (node, fp, wide, text_hash); texts: (text_hash, text). The doubtful links come as a forest, so they only tell within which groups
    links are to be sought: there all pairs near enough by their sketches are tested, but for such that
    are connected already. Small groups go together to tasks; one of more than so many nodes is cut into parts of that size, and each
    two parts meet in a task.
    """
    tested = materialize(tested_links(distinct, found.where("sure").select("a", "b"), texts, words, similarity), "tested")
    good = tested.where("passed").select("a", "b")
    doubtful = materialize(found.where("NOT sure").select("a", "b").union(tested.where("NOT passed").select("a", "b")), "doubtful")
    if doubtful.isEmpty():
        return good
    wide = components(found.select("a", "b")).withColumnRenamed("component", "above")  # a group's least node isn't listed
    groups = components(good).withColumnRenamed("component", "known")
    open_ = doubtful.join(wide, F.col("a") == F.col("node"), "left").select(F.coalesce("above", "a").alias("component")).distinct()
    members = distinct.join(wide, "node", "left").withColumn("component", F.coalesce("above", "node"))
    near = members.join(open_, "component", "left_semi").join(groups, "node", "left")
    near = materialize(near.select("node", "fp", "wide", "text_hash", "component", F.coalesce("known", "node").alias("known")), "near")
    parts = near.groupBy("component").agg(F.ceil(F.count("*") / size).cast("int").alias("parts"))
    rows = near.join(parts, "component").join(shingle_table(near, texts, words), "text_hash")
    own = F.pmod(F.xxhash64("node"), F.col("parts")).cast("int")
    others = F.transform(F.sequence(F.lit(0), F.col("parts") - 1), lambda k: F.struct(F.least(k, own).alias("i"), F.greatest(k, own).alias("j")))
    dealt = rows.withColumn("meet", F.explode(others)).withColumn("part", own)
    dealt = dealt.withColumn("bucket", F.when(F.col("parts") > 1, F.col("component")).otherwise(F.pmod(F.xxhash64("component"), F.lit(max(1, near.count() // size)))))

    def test(key: tuple, rows: pa.Table) -> pa.Table:
        cross = key[1] != key[2]  # pairs of one part meet elsewhere
        rows = rows.sort_by([("component", "ascending"), ("node", "ascending")])
        node, fp, known, component, part = (rows.column(c).to_numpy() for c in ("node", "fp", "known", "component", "part"))
        sketches = np.column_stack([fp.view(np.uint64), np.frombuffer(b"".join(rows.column("wide").to_pylist()), np.uint64).reshape(len(fp), -1)])
        flat = rows.column("shingles").combine_chunks()
        at, values = flat.offsets.to_numpy(), flat.values.to_numpy()
        ends = np.append(np.flatnonzero(component[1:] != component[:-1]) + 1, len(node))
        root: dict[int, int] = {}

        def find(n: int) -> int:
            while (up := root.setdefault(n, n)) != n:
                root[n] = n = root[up]
            return n

        u, v, low = [], [], 0
        for high in ends.tolist():
            for k in range(low, high - 1):
                rest = slice(k + 1, high)
                near = (np.bitwise_count(sketches[rest, 0] ^ sketches[k, 0]) <= bits) & (known[rest] != known[k])
                if cross:
                    near &= part[rest] != part[k]
                candidates = np.flatnonzero(near) + k + 1
                apart = np.bitwise_count(sketches[candidates] ^ sketches[k]).sum(1, dtype=np.int64)
                order = np.argsort(apart, kind="stable")
                for j in candidates[order[apart[order] <= wide_bits]].tolist():
                    p, q = find(int(known[k])), find(int(known[j]))
                    if p != q and jaccard(values[at[k]: at[k + 1]], values[at[j]: at[j + 1]]) >= similarity:
                        root[p] = q
                        u.append(node[k])
                        v.append(node[j])
            low = high
        return pa.table({"a": pa.array(u, pa.int64()), "b": pa.array(v, pa.int64())})

    kept = ["component", "node", "fp", "wide", "known", "part", "shingles"]
    passed = dealt.select("bucket", "meet", *kept).groupBy("bucket", "meet.i", "meet.j").applyInArrow(test, "a long, b long")
    return good.union(passed)


def tested_links(distinct: DataFrame, links: DataFrame, texts: DataFrame, words: int, similarity: float) -> DataFrame:
    """Adds passed to links: whether the distinct shingles of the two nodes' texts are similar enough."""
    nodes = distinct.join(links.select(F.col("a").alias("node")).union(links.select("b")).distinct(), "node", "left_semi")
    held = nodes.join(shingle_table(nodes, texts, words), "text_hash").select("node", "shingles")
    side = lambda name: held.select(F.col("node").alias(name), F.col("shingles").alias(f"of_{name}"))
    shared = F.size(F.array_intersect("of_a", "of_b"))
    either = F.size("of_a") + F.size("of_b") - shared
    return links.join(side("a"), "a").join(side("b"), "b").select("a", "b", ((either == 0) | (shared >= either * similarity)).alias("passed"))


def jaccard(a: np.ndarray, b: np.ndarray) -> float:
    """Similarity of two ascending lists of distinct hashes; two without any are equal."""
    shared = len(a) + len(b) - len(np.unique(np.concatenate([a, b])))
    return shared / (len(a) + len(b) - shared) if len(a) + len(b) else 1.0


def shingle_table(nodes: DataFrame, texts: DataFrame, words: int) -> DataFrame:
    """The distinct shingle hashes, ascending, of each text hash among nodes, written: (text_hash, shingles array)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = [np.unique(shingle_hashes(t, words)).view(np.int64) for t in b.column("text").to_pylist()]
            at = np.concatenate([[0], np.cumsum([len(x) for x in found])])
            yield pa.RecordBatch.from_arrays([b.column("text_hash"), pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.array(np.concatenate([np.zeros(0, np.int64), *found])))], ["text_hash", "shingles"])

    asked = nodes.select("text_hash").distinct()
    return materialize(texts.join(asked, "text_hash", "left_semi").dropDuplicates(["text_hash"]).mapInArrow(run, "text_hash long, shingles array<long>"), "shingles")


def similar_bits(similarity: float, bits: int, slack: float) -> int:
    """Bits of a sketch in which texts of such a Jaccard similarity of shingles differ at most.

    The sketch's angle shows the cosine of two sets, 2 s / (1 + s) for sets of one size; each
    bit differs with probability angle / pi. slack: standard deviations above the expected number.
    """
    p = math.acos(2 * similarity / (1 + similarity)) / math.pi
    return int(bits * p + slack * math.sqrt(bits * p * (1 - p)))


def drop_near_duplicates(docs: DataFrame, similarity: float = 0.8, words: int = 5) -> DataFrame:
    """Keeps one document of each near-duplicate group, whole: the one with the least doc_id.

    The 64-bit index lets pass what texts of such a Jaccard similarity of distinct shingles differ in with three
    standard deviations to spare. Of those, a sketch of 512 bits drops what is three such above what the
    similarity leads to; the shingles themselves decide on all others, so no document goes untested.
    Of rows that repeat the id that stays, the first by hash of the whole row stays; a group without any id keeps one row too.
    Rows are told apart by the XXH64 of id and text: among N rows about N * N / 2^65 pairs would be taken for one.
    """
    keys = docs.select("doc_id", "text", F.xxhash64("doc_id", "text").alias("_key"))
    bands = similar_bits(similarity, 512, -3.0), similar_bits(similarity, 512, 3.0)
    groups = near_duplicates(keys, similar_bits(similarity, 64, 3.0), words, more=7, bands=bands, similarity=similarity)
    best = groups.groupBy("group").agg(F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "_key")).alias("m")).select(F.col("m._key").alias("_keep"))
    marked = docs.select(F.struct(*docs.columns).alias("doc"), F.xxhash64("doc_id", "text").alias("_key"))
    kept = marked.join(best, marked["_key"] == F.col("_keep"), "left_semi")
    plain = [F.col("doc")[f.name] for f in docs.schema.fields if f.dataType.typeName() not in ("map", "variant")]
    return kept.groupBy("_key").agg(F.min_by("doc", F.xxhash64(*plain)).alias("doc")).select("doc.*")

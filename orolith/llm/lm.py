"""Stupid-backoff language-model scores, computed by joins on hash-partitioned counts.

Documents lie in blocks of some megabytes of text. Each block's distinct pairs of words, and
its distinct words, go with their numbers to the partition that their 64-bit hash falls
in. There they form the tables of counts over all documents, and are joined to them; what
returns to a block is the count of each of its n-grams. The block then sums logarithms
per document. A document's own occurrences are taken off all counts, so that it can't
vouch for itself.

For a pair (h, w) after leaving the document out: count(h w) / count(h ...) where the pair
is known, else BACKOFF * count(w) / total, an unknown word counting as 1 occurrence.

An n-gram has one entry a block however often it occurs, so a very frequent word or pair
is no partition of its own. Entries are packed into arrays of one row for each block and
partition: ascending keys by their differences, and no columns around them. Two n-grams share a hash with
probability 2^-64, so among N distinct ones N * N / 2^65 pairs mix their counts.

Defined results: a text of fewer than two words (null, empty, one word) has no pairs and a
null score; repeated rows are documents of their own that vouch for each other; a null id
keeps its row; an empty table gives no rows; other columns aren't read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialize

BACKOFF = 0.4
#: Bytes of text in a block, about; a longer text is a block of its own.
BLOCK = 4 << 20
#: Blocks of a file: so many are in a task's memory at once, and Spark's cost of opening a file bounds those that one task reads.
HELD = 2
#: Words of all documents to one partition of the counts, about.
PART = 1_000_000
#: Bytes hashed at once.
CHUNK = 1 << 20

SPACE = np.isin(np.arange(256), [0x20, *range(0x09, 0x0E)])
#: Odd multiplier of the polynomial hash and its inverse modulo 2^64; a value for each byte.
BASE = 0x9E3779B97F4A7C15
INVERSE = pow(BASE, -1, 1 << 64)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads each bit over all."""
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


BYTES = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(BASE))
_powers: dict[int, np.ndarray] = {}


def powers(base: int, n: int) -> np.ndarray:
    """base to the 0, 1, ... n - 1 at least, modulo 2^64."""
    held = _powers.get(base)
    if held is None or len(held) < n:
        held = np.full(max(n, CHUNK + (1 << 16)), base, np.uint64)
        held[0] = 1
        held = _powers[base] = np.cumprod(held, dtype=np.uint64)
    return held


def flat_texts(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of all texts, and where each begins, with the end; null texts are empty."""
    if texts.null_count:
        texts = pc.fill_null(texts, "")
    kind = np.int64 if pa.types.is_large_string(texts.type) else np.int32
    _, offsets, data = texts.buffers()
    at = np.frombuffer(offsets, kind)[texts.offset: texts.offset + len(texts) + 1].astype(np.int64) if len(texts) else np.zeros(1, np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return raw[at[0]: at[-1]], at - at[0]


def word_bounds(raw: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where words begin and end; they don't cross texts."""
    inside = np.concatenate([[False], ~SPACE[raw], [False]])
    fresh = np.zeros(len(raw) + 1, bool)
    fresh[at] = True
    begins = inside[1:] & (~inside[:-1] | fresh)
    ends = inside[:-1] & (~inside[1:] | fresh)
    return np.flatnonzero(begins), np.flatnonzero(ends)


def hash_words(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The 64-bit hash of every word of every text, in order, and the place of its text."""
    raw, at = flat_texts(texts)
    begins, ends = word_bounds(raw, at)
    out = np.empty(len(begins), np.uint64)
    k = 0
    while k < len(begins):
        low = begins[k]
        upto = max(k + 1, int(np.searchsorted(ends, low + CHUNK, side="right")))
        high = ends[upto - 1]
        sums = np.zeros(high - low + 1, np.uint64)
        np.cumsum(BYTES[raw[low:high]] * powers(BASE, high - low)[: high - low], out=sums[1:])
        b = begins[k:upto] - low
        out[k:upto] = (sums[ends[k:upto] - low] - sums[b]) * powers(INVERSE, high - low)[b]
        k = upto
    return mix(out + (ends - begins).astype(np.uint64)), np.searchsorted(at, begins, side="right") - 1


def ranks(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct values in ascending order, and the place of each value among them."""
    signed = (values ^ np.uint64(1 << 63)).view(np.int64) if values.dtype == np.uint64 else values  # sorts faster
    order = np.argsort(signed)
    ascending = values[order]
    fresh = np.ones(len(values), bool)
    np.not_equal(ascending[1:], ascending[:-1], out=fresh[1:])
    at = np.empty(len(values), np.int64)
    at[order] = np.cumsum(fresh) - 1
    return ascending[fresh], at


def pack(values: np.ndarray) -> bytes:
    """64-bit numbers with their lowest bytes first, then all of the next: high bytes are mostly zero, and compress away."""
    return values.astype("<u8").view(np.uint8).reshape(-1, 8).T.tobytes()


def unpack(rows: list[bytes]) -> list[np.ndarray]:
    return [np.frombuffer(x, np.uint8).reshape(8, -1).T.copy().view("<u8").ravel() for x in rows]


class Grams:
    """Words and pairs of a block: distinct keys in ascending order, and the entry of each occurrence."""

    def __init__(self, texts: pa.Array):
        hashes, self.doc = hash_words(texts)
        self.words, self.word = ranks(hashes)
        self.head = np.flatnonzero(self.doc[:-1] == self.doc[1:])  # words that begin a pair
        self.pairs, self.pair = ranks(mix(hashes[self.head] * np.uint64(3) + mix(hashes[self.head + 1])))

    def numbers(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Occurrences of pairs, of words, and of words as the first of a pair."""
        n = len(self.words)
        return np.bincount(self.pair, minlength=len(self.pairs)), np.bincount(self.word, minlength=n), np.bincount(self.word[self.head], minlength=n)

    def own(self, size: int, place: np.ndarray, doc: np.ndarray) -> np.ndarray:
        """For each occurrence, how often its document has the same entry."""
        _, at = ranks(doc * size + place)
        return np.bincount(at)[at]

    def logs(self, pair_all: np.ndarray, word_all: np.ndarray, head_all: np.ndarray, total: int, backoff: float) -> np.ndarray:
        """The logarithm of each pair's score in its document."""
        doc, h, w = self.doc[self.head], self.word[self.head], self.word[self.head + 1]
        others = pair_all[self.pair] - self.own(len(self.pairs), self.pair, doc)
        own = self.own(len(self.words), self.word, self.doc)
        last = np.zeros(int(self.doc[-1]) + 1 if len(self.doc) else 0, np.int64)
        last[self.doc] = self.word  # the last word of a text stays
        heads = head_all[h] - own[self.head] + (last[doc] == h)
        rest = np.maximum(word_all[w] - own[self.head + 1], 1)
        known = others > 0
        return np.where(known, np.log(np.where(known, others, 1)) - np.log(np.where(known, heads, 1)), np.log(backoff) + np.log(rest) - np.log(max(total, 1)))


def make_blocks(docs: DataFrame, size: int = BLOCK) -> DataFrame:
    """Documents in blocks of about so many bytes, in the shared folder: (block, n_words, doc_ids, texts)."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = TaskContext.get().partitionId() << 33
        for b in batches:
            ids, texts = b.column("doc_id"), b.column("text")
            raw, at = flat_texts(texts)
            low = 0
            while low < len(texts):
                high = max(low + 1, int(np.searchsorted(at, at[low] + size, side="right")) - 1)
                n = len(word_bounds(raw[at[low]: at[high]], at[low: high + 1] - at[low])[0])
                ends = pa.array([0, high - low], pa.int32())
                lists = [pa.ListArray.from_arrays(ends, x.slice(low, high - low)) for x in (ids, texts)]
                yield pa.RecordBatch.from_arrays([pa.array([block], pa.int64()), pa.array([n], pa.int64()), *lists], ["block", "n_words", "doc_ids", "texts"])
                block, low = block + 1, high

    return materialize(docs.select("doc_id", "text").mapInArrow(run, f"block long, n_words long, doc_ids array<{kind}>, texts array<string>"), "blocks", "zstd", HELD)


def explode_grams(blocks: DataFrame, parts: int) -> DataFrame:
    """Distinct n-grams of each block by the part of the hash range they fall in.

    Rows are (part, block, pairs, pair_n, words, word_n, head_n): packed numbers, and packed differences of ascending keys.
    """
    width = np.uint64((1 << 64) // parts + 1) if parts > 1 else np.uint64((1 << 64) - 1)
    names = ["part", "block", "pairs", "pair_n", "words", "word_n", "head_n"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for k, block in enumerate(b.column("block").to_pylist()):
                grams = Grams(b.column("texts")[k].values)
                pair_n, word_n, head_n = grams.numbers()
                pair_part, word_part = grams.pairs // width, grams.words // width
                found = np.union1d(pair_part, word_part)
                if not len(found):
                    continue
                cuts = [(np.searchsorted(p, found, "left").tolist(), np.searchsorted(p, found, "right").tolist()) for p in (pair_part, word_part)]
                keys = lambda x: np.diff(x, prepend=np.uint64(0))
                packed = [pa.array([pack(keys(x[i:j]) if x.dtype == np.uint64 else x[i:j]) for i, j in zip(*cut, strict=True)], pa.binary()) for x, cut in ((grams.pairs, cuts[0]), (pair_n, cuts[0]), (grams.words, cuts[1]), (word_n, cuts[1]), (head_n, cuts[1]))]
                yield pa.RecordBatch.from_arrays([pa.array(found.astype(np.int64)), pa.array(np.full(len(found), block)), *packed], names)

    return blocks.select("block", "texts").mapInArrow(run, "part long, block long, pairs binary, pair_n binary, words binary, word_n binary, head_n binary")


def join_counts(grams: DataFrame) -> DataFrame:
    """Counts over all documents of each row's n-grams: (part, block, pair_all, word_all, head_all)."""

    def totals(rows: pa.Table, keys: str, *numbers: str) -> Iterator[list[bytes]]:
        found = [np.cumsum(x, dtype=np.uint64) for x in unpack(rows.column(keys).to_pylist())]
        _, at = ranks(np.concatenate(found))
        ends = np.cumsum([len(x) for x in found])[:-1]
        for name in numbers:
            n = np.concatenate(unpack(rows.column(name).to_pylist()))
            yield [pack(x) for x in np.split(np.bincount(at, n).astype(np.int64)[at], ends)]

    def meet(rows: pa.Table) -> pa.Table:
        found = [*totals(rows, "pairs", "pair_n"), *totals(rows, "words", "word_n", "head_n")]
        return pa.table([rows.column("part"), rows.column("block"), *(pa.array(x, pa.binary()) for x in found)], ["part", "block", "pair_all", "word_all", "head_all"])

    return grams.groupBy("part").applyInArrow(meet, "part long, block long, pair_all binary, word_all binary, head_all binary")


def backoff_scores(docs: DataFrame, backoff: float = BACKOFF, block: int = BLOCK, part: int = PART) -> DataFrame:
    """Adds n_pairs and score (mean natural logarithm a pair) to doc_id: one row per document.

    block: bytes of text in a block; part: words to one partition of the counts. Both bound a task.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()
    blocks = make_blocks(docs, block)
    total = blocks.agg(F.coalesce(F.sum("n_words"), F.lit(0))).first()[0]
    counts = join_counts(explode_grams(blocks, max(1, -(-total // part))))
    texts = blocks.select(F.lit(None).cast("long").alias("part"), "block", *(F.lit(None).cast("binary").alias(c) for c in ("pair_all", "word_all", "head_all")), "doc_ids", "texts")

    def score(rows: pa.Table) -> pa.Table:
        rows = rows.sort_by("part")  # nulls last: the texts
        text = rows.slice(len(rows) - 1).combine_chunks()
        ids, texts = (text.column(c).chunk(0).flatten() for c in ("doc_ids", "texts"))
        all_counts = [np.concatenate([np.zeros(0, np.int64), *(x.astype(np.int64) for x in unpack(rows.column(c).slice(0, len(rows) - 1).to_pylist()))]) for c in ("pair_all", "word_all", "head_all")]
        grams = Grams(texts)
        doc = grams.doc[grams.head]
        n = np.bincount(doc, minlength=len(ids))
        logs = np.bincount(doc, grams.logs(*all_counts, total, backoff), minlength=len(ids))
        return pa.table([ids, pa.array(n.astype(np.int64)), pa.array(logs / np.maximum(n, 1), mask=n == 0)], ["doc_id", "n_pairs", "score"])

    return counts.unionByName(texts, allowMissingColumns=True).groupBy("block").applyInArrow(score, f"doc_id {kind}, n_pairs long, score double")

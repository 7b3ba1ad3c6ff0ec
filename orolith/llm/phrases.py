"""Phrase collocations: count-min sketches find what may be frequent, a second pass counts it exactly.

Texts are lower-cased in A to Z, split at marks and line ends into pieces, and those at spaces and tabs into words.
Phrases are contiguous words of one piece, counted per language.

Sketches: each task counts the n-grams of its texts in rows of cells, and sends the cells that it
filled. Added up over the tasks they overestimate, so an n-gram that occurs min_count times reaches
min_count in each row. What goes back to the tasks is one bit a cell. Words and pairs are sketched first; longer
n-grams by a pass of their own for each length, and only those whose two parts of one word less have passed. The
exact pass counts the words and phrases all of whose parts have passed, by block and then by Spark over all blocks.

Cells are as many as an eighth of the bytes of text, up to WIDTH: bits of at most ROWS * WIDTH / 8 bytes are broadcast
for each pass. Beyond that the estimates grow, more survives, and the exact pass has more to count; results stay
the same. Two phrases of a block share a 64-bit hash with probability 2^-64.

Defined results: a null text has no words, a null language is `und`; repeated rows are documents of their own; ids and
other columns aren't read; an empty table, or one without frequent phrases, gives no rows. Texts are read whole, in windows that
end between pieces.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import materialize
from .lm import BASE, BYTES, INVERSE, flat_texts, mix, powers

#: Rows of a sketch, and the most cells of a row.
ROWS, WIDTH = 2, 1 << 25
#: Cells that one row of a sent sketch covers.
SLICE = 1 << 16
#: Bytes of text counted at once, about.
WINDOW = 1 << 20
#: Bytes looked at in one step for the end of a piece.
STEP = 1 << 15
#: Distinct n-grams that a task holds before it sends what it has counted.
HELD = 2_000_000

BLANK = np.isin(np.arange(256), [0x20, 0x09])
MARK = np.isin(np.arange(256), [*b".,;:!?", *range(0x0A, 0x0E)])
LOWER = np.where(np.isin(np.arange(256), np.arange(65, 91)), np.arange(256) + 32, np.arange(256)).astype(np.uint8)
#: Odd multipliers that deal hashes to the cells of each row.
DEAL = [np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(0x165667B19E3779F9), np.uint64(0x27D4EB2F165667C5)]


class Block:
    """The words of a window of texts: where they lie, their hashes, and which of them follow the one before in a piece."""

    def __init__(self, raw: np.ndarray, starts: np.ndarray, seeds: np.ndarray):
        """starts: where texts begin in raw; seeds: a number for each text's language."""
        fresh = np.zeros(len(raw) + 1, bool)
        fresh[starts] = True
        mark, inside = MARK[raw], np.concatenate([[False], ~(BLANK | MARK)[raw], [False]])
        self.raw = raw
        self.begins = np.flatnonzero(inside[1:] & (~inside[:-1] | fresh))
        self.ends = np.flatnonzero(inside[:-1] & (~inside[1:] | fresh))
        self.text = np.searchsorted(starts, self.begins, side="right") - 1
        broken = np.cumsum(np.concatenate([[0], mark])) + np.cumsum(fresh)
        piece = broken[self.begins]
        self.follows = np.concatenate([[False], piece[1:] == piece[:-1]]) if len(piece) else np.zeros(0, bool)
        sums = np.zeros(len(raw) + 1, np.uint64)
        np.cumsum(BYTES[raw] * powers(BASE, len(raw))[: len(raw)], out=sums[1:])
        words = (sums[self.ends] - sums[self.begins]) * powers(INVERSE, len(raw) + 1)[self.begins]
        self.grams = [mix(words + (self.ends - self.begins).astype(np.uint64)) ^ seeds[self.text]]
        self.words = self.grams[0]
        self.whole = [np.ones(len(self.begins), bool)]

    def order(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        """Hashes of the n words from each word on, and where that many follow in the piece. The last n - 1 places stay unused."""
        while len(self.grams) < n:
            k = len(self.grams)
            whole = np.zeros(len(self.words), bool)
            whole[: len(self.words) - k] = self.whole[-1][: len(self.words) - k] & self.follows[k:]
            grams = np.zeros(len(self.words), np.uint64)
            grams[: len(self.words) - k] = mix(self.grams[-1][: len(self.words) - k] * np.uint64(2 * k + 1) + mix(self.words[k:] + np.uint64(k)))
            self.grams.append(grams)
            self.whole.append(whole)
        return self.grams[n - 1], self.whole[n - 1]

    def phrases(self, at: np.ndarray, n: int) -> list[bytes]:
        """The n words from each place on, with a space between them."""
        raw, low, high = self.raw.tobytes(), self.begins[at], self.ends[at + n - 1]
        plain = np.ones(len(at), bool)  # one space lies between the words already
        for k in range(n - 1):
            gap = self.ends[at + k]
            plain &= (self.begins[at + k + 1] == gap + 1) & (self.raw[gap] == 0x20)
        found = [raw[i:j] for i, j in zip(low.tolist(), high.tolist(), strict=True)]
        for k in np.flatnonzero(~plain).tolist():
            found[k] = b" ".join([w for w in found[k].replace(b"\t", b" ").split(b" ") if w])
        return found


def window_end(raw: np.ndarray, at: np.ndarray, wanted: int) -> int:
    """The first end of a piece or text from a place on."""
    if wanted >= len(raw):
        return len(raw)
    text_end = int(at[np.searchsorted(at, wanted)])
    for low in range(wanted - 1, text_end, STEP):
        marks = np.flatnonzero(MARK[raw[low: min(low + STEP, text_end)]])
        if len(marks):
            return low + int(marks[0]) + 1
    return text_end


def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[Block, list[str]]]:
    """Windows of the texts of batches (lang, text), cut between pieces, with the language of each text."""
    for b in batches:
        raw, at = flat_texts(b.column("text"))
        langs = [x if x is not None else "und" for x in b.column("lang").to_pylist()]
        seeds = {x: np.uint64(int.from_bytes(hashlib.blake2b(x.encode(), digest_size=8).digest(), "little")) for x in set(langs)}
        of_text = np.array([seeds[x] for x in langs], np.uint64)
        low = 0
        while low < len(raw):
            high = window_end(raw, at, low + WINDOW)
            first, last = int(np.searchsorted(at, low, side="right")) - 1, int(np.searchsorted(at, high, side="left"))
            yield Block(LOWER[raw[low:high]], np.maximum(at[first:last] - low, 0), of_text[first:last]), langs[first:last]
            low = high


def cells(hashes: np.ndarray, row: int, width: int) -> np.ndarray:
    return (mix(hashes * DEAL[row]) & np.uint64(width - 1)).astype(np.int64)


class Passed:
    """The bits of merged sketches: which cells have reached min_count. Orders 1 and 2 share a sketch."""

    def __init__(self, bits: list[np.ndarray], width: int):
        self.bits, self.width = bits, width

    def test(self, hashes: np.ndarray, n: int) -> np.ndarray:
        rows, good = self.bits[max(n - 2, 0)], np.ones(len(hashes), bool)
        for k, row in enumerate(rows):
            alive = np.flatnonzero(good)
            at = cells(hashes[alive], k, self.width)
            good[alive] = (row[at >> 3] >> (at & 7).astype(np.uint8)) & 1 > 0
        return good

    def survivors(self, block: Block, n: int, itself: bool = True) -> np.ndarray:
        """Where n words are a phrase all of whose parts, and with itself the phrase, have passed."""
        _, whole = block.order(n)
        good = whole.copy()
        for k in range(1, n + itself):
            grams, _ = block.order(k)
            for shift in range(n - k + 1):
                alive = np.flatnonzero(good)
                good[alive] = self.test(grams[alive + shift], k)
        return np.flatnonzero(good)


def task_sketches(docs: DataFrame, orders: tuple[int, ...], width: int, min_count: int, passed: Broadcast | None) -> DataFrame:
    """(slice, cells, counts): what each task's texts add to the cells, by slices of a row; counts stop at min_count, which is enough to pass.

    cells holds 16-bit places as differences, their low bytes before their high ones; it is empty where counts has a number for each cell.
    """
    kind = np.uint8 if min_count < 256 else np.uint32

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.zeros((ROWS, width), kind)
        for block, _ in blocks(batches):
            for n in orders:
                grams, whole = block.order(n)
                grams = grams[whole] if passed is None else grams[passed.value.survivors(block, n, itself=False)]
                for k in range(ROWS):
                    at, n = np.unique(cells(grams, k, width), return_counts=True)
                    held[k][at] = np.minimum(held[k][at] + n, min_count)
        part = min(SLICE, width)
        rows = held.reshape(-1, part)
        for low in range(0, len(rows), 64):
            out = []
            for s in range(low, min(low + 64, len(rows))):
                at = np.flatnonzero(rows[s])
                if len(at):
                    dense = len(at) > part // 3
                    places = b"" if dense else np.diff(at, prepend=0).astype("<u2").view(np.uint8).reshape(-1, 2).T.tobytes()
                    counts = np.ascontiguousarray(rows[s] if dense else rows[s][at]).view(np.uint8)
                    out.append((s, places, counts.reshape(-1, held.itemsize).T.tobytes()))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array([x[0] for x in out], pa.int64()), *(pa.array([x[i] for x in out], pa.binary()) for i in (1, 2))], ["slice", "cells", "counts"])

    return docs.select("lang", "text").mapInArrow(run, "slice long, cells binary, counts binary")


def merge_sketches(sketches: DataFrame, width: int, min_count: int) -> DataFrame:
    """(slice, bits): which cells of each slice reach min_count over all tasks. Slices are added up as they stream by, so none is ever gathered whole."""
    part, size = min(SLICE, width), 1 if min_count < 256 else 4

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, total = None, np.zeros(part, np.int64)

        def done() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([now], pa.int64()), pa.array([np.packbits(total >= min_count, bitorder="little").tobytes()], pa.binary())], ["slice", "bits"])

        for b in batches:
            for s, places, counts in zip(*(b.column(k).to_pylist() for k in range(3)), strict=True):
                if s != now:
                    if now is not None:
                        yield done()
                    now = s
                    total[:] = 0
                counts = np.frombuffer(counts, np.uint8).reshape(size, -1).T.copy().view(f"<u{size}").ravel()
                if places:
                    total[np.cumsum(np.frombuffer(places, np.uint8).reshape(2, -1).T.copy().view("<u2").ravel().astype(np.int64))] += counts
                else:
                    total += counts
        if now is not None:
            yield done()

    return sketches.repartition("slice").sortWithinPartitions("slice").mapInArrow(run, "slice long, bits binary")


def sketch_bits(docs: DataFrame, orders: tuple[int, ...], width: int, min_count: int, passed: Broadcast | None) -> np.ndarray:
    """A bit for each cell of each row, packed; at most ROWS * WIDTH / 8 bytes come to the driver."""
    part = min(SLICE, width)
    bits = np.zeros((ROWS * width // part, max(part // 8, 1)), np.uint8)
    for s, row in merge_sketches(task_sketches(docs, orders, width, min_count, passed), width, min_count).collect():
        bits[s] = np.frombuffer(row, np.uint8)
    return bits.reshape(ROWS, -1)


class Counted:
    """Distinct n-grams of one length that a task has met: sorted hashes, numbers, languages, and where in the pool their words are. Some 50 bytes each."""

    def __init__(self):
        self.keys, self.n, self.lang, self.at = np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int32), np.zeros(0, np.int64)
        self.pool: list[pa.Array] = []

    def add(self, keys: np.ndarray, n: np.ndarray, lang: np.ndarray, words: Callable[[np.ndarray], list[bytes]]) -> None:
        """keys: ascending and distinct; words gives the words of those of them that are new."""
        place = np.searchsorted(self.keys, keys)
        known = place < len(self.keys)
        known[known] = self.keys[place[known]] == keys[known]
        self.n[place[known]] += n[known]
        new = np.flatnonzero(~known)
        if len(new):
            at = np.arange(len(self.keys), len(self.keys) + len(new))
            self.pool.append(pa.array(words(new), pa.large_binary()))
            self.keys, self.n, self.lang, self.at = (np.insert(old, place[new], more) for old, more in ((self.keys, keys[new]), (self.n, n[new]), (self.lang, lang[new]), (self.at, at)))

    def batches(self, k: int, names: list[str]) -> Iterator[pa.RecordBatch]:
        if not len(self.keys):
            return
        pool = pa.concat_arrays(self.pool)
        code, n = np.empty(len(pool), np.int32), np.empty(len(pool), np.int64)
        code[self.at], n[self.at] = self.lang, self.n
        order = pc.sort_indices(pool).to_numpy()  # rows whose phrases begin alike lie together, so that shuffles compress well
        for low in range(0, len(order), 100_000):
            part = order[low: low + 100_000]
            words = pool.take(pa.array(part)).cast(pa.large_string()).cast(pa.string())
            langs = pa.array(names, pa.string()).take(pa.array(code[part]))
            yield pa.RecordBatch.from_arrays([langs, pa.array(np.full(len(words), k, np.int32)), words, pa.array(n[part])], ["lang", "k", "phrase", "n"])


def count_survivors(docs: DataFrame, passed: Broadcast, longest: int) -> DataFrame:
    """(lang, k, phrase, n): occurrences of phrases of k words in parts of the table; k is 0 for the number of all words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes: dict[str, int] = {}
        totals: dict[str, int] = {}
        held = [Counted() for _ in range(longest)]
        for block, langs in blocks(batches):
            of_text = np.array([codes.setdefault(x, len(codes)) for x in langs], np.int32)
            for i, n in enumerate(np.bincount(block.text, minlength=len(langs)).tolist()):
                totals[langs[i]] = totals.get(langs[i], 0) + n
            for k in range(1, longest + 1):
                at = passed.value.survivors(block, k)
                keys, first, n = np.unique(block.order(k)[0][at], return_index=True, return_counts=True)
                place = at[first]
                held[k - 1].add(keys, n, of_text[block.text[place]], lambda new, place=place, block=block, k=k: block.phrases(place[new], k))
            if sum(len(x.keys) for x in held) > HELD:
                for k, found in enumerate(held, 1):
                    yield from found.batches(k, list(codes))
                held = [Counted() for _ in range(longest)]
        for k, found in enumerate(held, 1):
            yield from found.batches(k, list(codes))
        some = [(x, n) for x, n in totals.items() if n]
        if some:
            yield pa.RecordBatch.from_arrays([pa.array([x for x, _ in some], pa.string()), pa.array(np.zeros(len(some), np.int32)), pa.array([""] * len(some), pa.string()), pa.array([n for _, n in some], pa.int64())], ["lang", "k", "phrase", "n"])

    return docs.select("lang", "text").mapInArrow(run, "lang string, k int, phrase string, n long")


def frequent_phrases(docs: DataFrame, min_count: int = 10, longest: int = 3, width: int = WIDTH) -> DataFrame:
    """(lang, k, phrase, n): exact counts of all words and phrases of up to so many words that occur min_count times, and with k = 0 of all words.

    width: the most cells of a sketch's row, a power of two.
    """
    spark = docs.sparkSession
    size = docs.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    width = min(width, 1 << max(10, (size // 8).bit_length()))
    bits = [sketch_bits(docs, (1, 2)[:longest], width, min_count, None)]
    passed = spark.sparkContext.broadcast(Passed(bits, width))
    for n in range(3, longest + 1):
        bits = [*bits, sketch_bits(docs, (n,), width, min_count, passed)]
        passed = spark.sparkContext.broadcast(Passed(bits, width))
    counted = count_survivors(docs, passed, longest).groupBy("lang", "k", "phrase").agg(F.sum("n").alias("n"))
    return counted.where((F.col("k") == 0) | (F.col("n") >= min_count))


def collocations(docs: DataFrame, min_count: int = 10, longest: int = 3, share: int = 50, top: int = 2000, width: int = WIDTH) -> DataFrame:
    """The best top phrases of each language: (lang, rank, phrase, a, l, r, n, score).

    a: occurrences of the phrase; l and r: of its two parts at the lowest-scoring cut; n: all words of the
    language. score: floor(1000000 * a * a / (l * r)) in exact arithmetic, equal ones by the earliest cut. A phrase goes whose words lie in a longer frequent
    one with at least share per cent of its occurrences, whether that one stays or not.
    """
    counts = materialize(frequent_phrases(docs, min_count, longest, width), "phrases")
    parts = counts.where(f"k between 1 and {longest - 1}").select(F.col("lang").alias("_lang"), F.col("phrase").alias("_part"), F.col("n").alias("_n"))
    phrases = counts.where("k > 1").select("lang", "k", "phrase", F.col("n").alias("a"), F.split("phrase", " ").alias("ws"))
    words = lambda first, n: F.array_join(F.slice("ws", first, n), " ")
    cut = phrases.select("lang", "phrase", "a", "k", "ws", F.explode(F.sequence(F.lit(1), F.col("k") - 1)).alias("cut"))
    cut = cut.select("lang", "phrase", "a", "cut", words(F.lit(1), F.col("cut")).alias("first"), words(F.col("cut") + 1, F.col("k") - F.col("cut")).alias("rest"))
    for name, side in (("l", "first"), ("r", "rest")):
        cut = cut.join(parts, (F.col("lang") == F.col("_lang")) & (F.col(side) == F.col("_part"))).withColumnRenamed("_n", name).drop("_lang", "_part")
    exact = lambda c: f"cast({c} as decimal(15, 0))"
    score = F.expr(f"({exact('a')} * {exact('a')} * cast(1000000 as decimal(7, 0))) div ({exact('l')} * {exact('r')})")
    scored = cut.withColumn("score", score).groupBy("lang", "phrase", "a").agg(F.min(F.struct("score", "cut", "l", "r")).alias("s")).select("lang", "phrase", "a", "s.l", "s.r", "s.score")
    spans = F.flatten(F.transform(F.sequence(F.lit(2), F.col("k") - 1), lambda n: F.transform(F.sequence(F.lit(1), F.col("k") - n + 1), lambda i: F.array_join(F.slice("ws", i, n), " "))))
    longer = phrases.where("k > 2").select("lang", F.col("a").alias("n"), F.explode(spans).alias("part")).groupBy(F.col("lang").alias("_lang"), F.col("part").alias("_part")).agg(F.max("n").alias("longer"))
    kept = scored.join(longer, (F.col("lang") == F.col("_lang")) & (F.col("phrase") == F.col("_part")), "left").where(F.coalesce(F.col("longer") * 100 < F.col("a") * share, F.lit(True)))
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    best = kept.withColumn("rank", F.row_number().over(order).cast("long")).where(F.col("rank") <= top)
    totals = counts.where("k = 0").select(F.col("lang").alias("_of"), F.col("n"))
    return best.join(totals, F.col("lang") == F.col("_of")).select("lang", "rank", "phrase", "a", "l", "r", "n", "score")

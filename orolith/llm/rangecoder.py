"""Token ids in files, coded by an adaptive context-mixing range coder.

A segment holds whole documents in order. Its ids are cut into blocks of BLOCK; each block
starts from a fresh model and has a CRC-32 of its ids, so blocks decode independently and a
damaged one is found. Up to LANES blocks form a group and run in step: one NumPy operation
does the same step of each. An id is one step, so a group takes BLOCK steps.

The model of an id: the two ids before it and the one before it each predict the id seen
there last, with a confidence. Both confidences, and whether the predictions agree, choose
a row of weights that adapts inside the block, so predictions are mixed as they have proved
good: the coder gives an id the weight w2 if order 2 guesses it, else w1 if order 1 does,
else (1 - w2 - w1) P(order 0). Order 0 has the frequencies of the group, which stand ahead of
its blocks. All of it is one interval of a range coder with 64-bit state, 32-bit output
words and carries carried into words already out. A damaged table of frequencies is found
and makes its whole group unreadable.

Layout (little-endian): magic "ORC2", id count u64, document count u64, block length u32;
lengths of documents u32; then groups. A group: byte count of its table u32; the table under
zlib (distinct ids u32 as differences, their frequencies u32, which add up to a power of two);
per block word count u32 and CRC-32 u32; words u32 of all its blocks.

Defined results: a null or empty text is a document of its end id alone; repeated rows and
null ids are documents of their own, null ids first; an empty table gives no segments.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .tokens import ids_of

MAGIC, HEADER = b"ORC2", "<4sQQI"
BLOCK = 4096
#: Ids of a segment, about: a task holds the ids of one.
SEGMENT = 4_000_000
#: Blocks that run in step. Their tables share the memory of one task, however long a document is.
LANES = 2048
#: Slots of the order-1 and of the order-2 table of a block, as a power of two.
SLOTS = 12
#: Weights add up to 1 << WEIGHT. A step moves them by a share of 1 / (1 << RATE); REST is about what order 2 and 1 leave to order 0 at least.
WEIGHT, RATE, REST = 16, 5, 1024
GAIN = ((1 << WEIGHT) - REST) >> RATE
#: Bits of the sum of order-0 frequencies, at least and at most: the narrowest range still has room for each.
SCALE, SCALES = 16, 24


def _u8(x: int) -> np.ndarray:
    """A constant that NumPy needn't convert in each step."""
    return np.array(x, np.uint64)


def _u4(x: int) -> np.ndarray:
    return np.array(x, np.uint32)


NONE, LOW, WORD, HALF, SHARE = _u8(0), _u8(1 << 32), _u8(32), _u8(2**32 - 1), _u8(WEIGHT)
#: How weights (order 2 in the lower half, order 1 in the upper) shrink, and what is added where order 2 or order 1 guessed the id.
DECAY, KEPT, GAIN2, GAIN1 = _u8(RATE), _u8((2**32 - 1 >> RATE) * (2**32 + 1)), _u8(GAIN), _u8(GAIN << 32)
#: Of contexts, and of entries of the tables.
MASK, HASH, UP, SURE, TWO = np.array((1 << SLOTS) - 1), np.array(40503), _u4(3), _u4(6), _u4(2)


def _start() -> np.ndarray:
    """The first weights for each (confidence of order 2, of order 1, whether they agree); none falls below 31."""
    by2, by1 = (np.array(x) << WEIGHT - 8 for x in ((4, 96, 160, 216), (8, 48, 80, 112)))
    sure2, sure1, agree = np.unravel_index(np.arange(32), (4, 4, 2))
    two = np.where(agree, np.maximum(by2[sure2], by1[sure1]), by2[sure2])
    one = np.where(agree, 31, by1[sure1] * ((1 << WEIGHT) - two) >> WEIGHT)
    return (two | one << 32).astype(np.uint64)


START = _start()


class Zero:
    """Order 0: a group's distinct ids, known by their ranks, and frequencies that add up to 1 << bits."""

    def __init__(self, values: np.ndarray, freqs: np.ndarray):
        self.values = values
        self.freq = freqs.astype(np.uint64)
        self.sums = np.cumsum(self.freq) - self.freq
        self.total = int(self.freq.sum())
        self.bits = _u8(self.total.bit_length() - 1)
        if not len(values) or self.total != 1 << int(self.bits) or not (SCALE <= self.bits <= SCALES) or not freqs.all():
            raise ValueError("not a table of frequencies of this format")

    @classmethod
    def of(cls, ids: np.ndarray) -> tuple[Zero, np.ndarray]:
        """The frequencies of these ids (at most LANES * BLOCK), and their ranks."""
        if ids.max() < 1 << 22:
            seen = np.bincount(ids)
            values = np.flatnonzero(seen)
            counts, ranks = seen[values], np.zeros(len(seen), np.uint32)
            ranks[values] = np.arange(len(values))
            ranks = ranks[ids]
        else:
            values, ranks, counts = np.unique(ids, return_inverse=True, return_counts=True)
        total = 1 << max(SCALE, (len(values) - 1).bit_length() + 1)
        freqs = 1 + counts * (total - len(values)) // len(ids)
        freqs[freqs.argmax()] += total - freqs.sum()
        return cls(values.astype(np.uint32), freqs), ranks.astype(np.uint32)

    def at(self) -> np.ndarray:
        """The rank that holds each number below the sum of frequencies."""
        return np.repeat(np.arange(len(self.freq)), self.freq.astype(np.int64))

    def pack(self) -> bytes:
        told = zlib.compress(np.diff(self.values, prepend=np.uint32(0)).astype("<u4").tobytes() + self.freq.astype("<u4").tobytes(), 6)
        return struct.pack("<I", len(told)) + told

    @classmethod
    def unpack(cls, told: bytes) -> Zero:
        try:
            values, freqs = np.frombuffer(zlib.decompress(told), "<u4").reshape(2, -1)
        except zlib.error as e:
            raise ValueError("a group's table of frequencies is damaged") from e
        return cls(np.cumsum(values, dtype=np.uint32), freqs)


class Model:
    """The adaptive state of so many blocks, and the walk through one id that coder and decoder share. Ids are known by their ranks.

    Tables hold the rank seen last in each context, with a confidence (0 to 3) in bits 1 and 2. A slot's
    entries lie side by side for all blocks, since blocks use the same slots often. Order 1 comes first, then order 2.
    """

    def __init__(self, blocks: int):
        self.weights, self.base = np.tile(START, blocks), np.arange(blocks) * len(START)
        self.held, self.blocks = np.zeros(2 * blocks << SLOTS, np.uint32), np.array(blocks)
        self.lane = np.stack([np.arange(blocks), np.arange(blocks) + (blocks << SLOTS)])
        self.context, self.last = np.zeros((2, blocks), np.int64), np.zeros(blocks, np.int64)

    def predict(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The ranks that order 1 and order 2 guess, and the weights of order 2 and of order 1."""
        self.at = (self.context & MASK) * self.blocks + self.lane
        self.entry = self.held.take(self.at, mode="clip")
        guess, sure = self.entry >> UP, self.entry & SURE
        self.row = (sure[1] << TWO | sure[0] | (guess[0] == guess[1])) + self.base
        self.now = self.weights.take(self.row, mode="clip")
        return guess, self.now & HALF, self.now >> WORD

    def learn(self, ids: np.ndarray, ranks: np.ndarray, wrong: np.ndarray, hit: np.ndarray, not2: np.ndarray) -> None:
        """ids: the ranks as entries have them; wrong: which guesses were; hit: the blocks where one was right, and not2: where that is order 1 alone."""
        now = self.now - (self.now >> DECAY & KEPT)
        now[hit] += np.where(not2, GAIN1, GAIN2)
        self.weights[self.row] = now
        self.held[self.at] = np.where(wrong, ids << UP, np.minimum(self.entry + TWO, self.entry | SURE))
        np.add(self.last * HASH, ranks, out=self.context[1])
        self.context[0] = self.last = ranks


class Encoder:
    def __init__(self, blocks: int, length: int):
        self.low, self.range = np.zeros(blocks, np.uint64), np.full(blocks, 2**64 - 1, np.uint64)
        #: Words, with what they carry into the word before above them.
        self.out = np.zeros((length + 1) * blocks, np.uint64)
        self.carries, self.blocks = np.zeros(blocks, bool), blocks
        self.at = np.arange(blocks)

    def put(self, offset: np.ndarray, width: np.ndarray) -> None:
        """Narrows each block's range to width, from offset on."""
        low = self.low
        low += offset
        self.carries |= low < offset  # once between two words at most
        small = (width < LOW).nonzero()[0]
        at, head = self.at[small], low[small]
        self.out[at] = head >> WORD | self.carries[small].astype(np.uint64) << WORD
        self.at[small] = at + self.blocks
        self.carries[small] = False
        low[small] = head << WORD
        width[small] <<= WORD
        self.range = width

    def finish(self) -> list[np.ndarray]:
        last = self.low + HALF
        self.out[self.at] = last >> WORD | (self.carries | (last < self.low)).astype(np.uint64) << WORD
        rows = self.out.reshape(-1, self.blocks)
        for k in range(int(self.at.max()) // self.blocks, 0, -1):
            rows[k - 1] += rows[k] >> WORD
        return [w[:n] for w, n in zip(rows.astype(np.uint32).T, (self.at // self.blocks + 1).tolist(), strict=True)]


class Decoder:
    def __init__(self, stream: np.ndarray, counts: np.ndarray):
        n, self.blocks = int(counts.max()) + 2, len(counts)
        words = np.zeros((self.blocks, n), np.uint32)
        words[np.arange(n) < counts[:, None]] = stream
        self.words = np.ascontiguousarray(words.T).reshape(-1)
        self.range = np.full(self.blocks, 2**64 - 1, np.uint64)
        self.code = words[:, 0].astype(np.uint64) << WORD | words[:, 1]
        self.at = np.arange(2 * self.blocks, 3 * self.blocks)

    def got(self, code: np.ndarray, width: np.ndarray) -> None:
        """Goes on with each block's code inside an interval of that width."""
        small = (width < LOW).nonzero()[0]
        at = self.at[small]
        code[small] = code[small] << WORD | self.words.take(at, mode="clip")
        self.at[small] = at + self.blocks
        width[small] <<= WORD
        self.code, self.range = code, width


def _block_sizes(ids: int) -> np.ndarray:
    blocks = -(-ids // BLOCK)
    return np.minimum(BLOCK, ids - BLOCK * np.arange(blocks))


def _checks(ids: np.ndarray) -> list[int]:
    """The CRC-32 of each block."""
    raw = memoryview(np.ascontiguousarray(ids, "<u4")).cast("B")
    return [zlib.crc32(raw[k: k + 4 * BLOCK]) for k in range(0, len(raw), 4 * BLOCK)]


def _encode_group(ids: np.ndarray) -> bytes:
    sizes, (zero, ranks) = _block_sizes(len(ids)), Zero.of(ids)
    steps = np.ascontiguousarray(np.pad(ranks, (0, -len(ranks) % BLOCK)).reshape(-1, BLOCK)[:, : sizes[0]].T)
    del ranks
    model, coder = Model(len(sizes)), Encoder(len(sizes), int(sizes[0]))
    for now in steps:
        guess, w2, w1 = model.predict()
        wrong, rank, whole = guess != now, now.astype(np.int64), coder.range
        hit = (~(wrong[0] & wrong[1])).nonzero()[0]
        share = whole >> SHARE
        width2, width1 = share * w2, share * w1
        both = width2 + width1
        part = whole - both >> zero.bits
        offset, width = both + part * zero.sums.take(rank, mode="clip"), part * zero.freq.take(rank, mode="clip")
        not2, by2 = wrong[1][hit], width2[hit]
        offset[hit] = np.where(not2, by2, NONE)
        width[hit] = np.where(not2, width1[hit], by2)
        coder.put(offset, width)
        model.learn(now, rank, wrong, hit, not2)
    words = coder.finish()
    told = np.array([[len(w) for w in words], _checks(ids)], "<u4").T
    return zero.pack() + told.tobytes() + np.concatenate(words).astype("<u4").tobytes()


def _decode_group(segment: bytes, at: int, n: int) -> tuple[np.ndarray, list[bool], int]:
    """The ids of a group of n ids from there on, whether each block is sound, and where the group ends."""
    (told,) = struct.unpack_from("<I", segment, at)
    at += 4
    zero, sizes = Zero.unpack(segment[at: at + told]), _block_sizes(n)
    table = np.frombuffer(segment, "<u4", 2 * len(sizes), at + told).reshape(-1, 2)
    at += told + table.nbytes
    stream = np.frombuffer(segment, "<u4", int(table[:, 0].sum()), at)
    model, coder, rank_at = Model(len(sizes)), Decoder(stream, table[:, 0]), zero.at()
    steps = np.zeros((int(sizes[0]), len(sizes)), np.uint32)
    for now in steps:
        guess, w2, w1 = model.predict()
        code, whole = coder.code, coder.range
        share = whole >> SHARE
        width2, width1 = share * w2, share * w1
        both = width2 + width1
        hit = (code < both).nonzero()[0]
        # where a guess was right, what follows from order 0 is replaced; in damaged blocks ranks are cut to those there are
        part, left = whole - both >> zero.bits, code - both
        rank = rank_at.take((left // part).view(np.int64), mode="clip")
        left -= part * zero.sums.take(rank, mode="clip")
        width = part * zero.freq.take(rank, mode="clip")
        seen, by2 = code[hit], width2[hit]
        not2 = seen >= by2
        rank[hit] = np.where(not2, guess[0][hit], guess[1][hit])
        left[hit] = np.where(not2, seen - by2, seen)
        width[hit] = np.where(not2, width1[hit], by2)
        coder.got(left, width)
        now[:] = rank
        model.learn(now, rank, guess != now, hit, not2)
    ids = zero.values.take(steps.T.ravel()[:n])
    return ids, [a == b for a, b in zip(_checks(ids), table[:, 1].tolist(), strict=True)], at + stream.nbytes


def encode_segment(docs: list[np.ndarray]) -> bytes:
    """One segment from the ids (u4) of its documents."""
    ids = np.concatenate([np.zeros(0, np.uint32), *docs]).astype(np.uint32)
    head = struct.pack(HEADER, MAGIC, len(ids), len(docs), BLOCK) + np.array([len(d) for d in docs], "<u4").tobytes()
    return b"".join([head, *(_encode_group(ids[k: k + LANES * BLOCK]) for k in range(0, len(ids), LANES * BLOCK))])


def decode_blocks(segment: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All ids (u4) of a segment, the lengths of its documents, and whether each block's checksum holds.

    Blocks are independent: those that are sound have their ids whatever the others hold.
    """
    magic, n, docs, block = struct.unpack_from(HEADER, segment)
    if magic != MAGIC or block != BLOCK:
        raise ValueError("not a segment of this format")
    at = struct.calcsize(HEADER)
    lengths = np.frombuffer(segment, "<u4", docs, at)
    at += 4 * docs
    ids, sound = [np.zeros(0, np.uint32)], []
    for k in range(0, n, LANES * BLOCK):
        some, right, at = _decode_group(segment, at, min(LANES * BLOCK, n - k))
        ids.append(some)
        sound += right
    return np.concatenate(ids), lengths, np.array(sound, bool)


def decode_segment(segment: bytes) -> list[np.ndarray]:
    """The ids (u4) of each document of a segment. Raises ValueError where a block's checksum fails."""
    ids, lengths, sound = decode_blocks(segment)
    if not sound.all():
        raise ValueError(f"blocks {np.flatnonzero(~sound).tolist()} are damaged")
    return np.split(ids, np.cumsum(lengths)[:-1]) if len(lengths) else []


def salvage_segment(segment: bytes) -> list[np.ndarray | None]:
    """The ids of each document that lies in sound blocks alone, None for the others."""
    ids, lengths, sound = decode_blocks(segment)
    ends = np.cumsum(lengths.astype(np.int64))
    starts = ends - lengths
    return [ids[a:b] if sound[a // BLOCK: -(-b // BLOCK)].all() else None for a, b in zip(starts.tolist(), ends.tolist(), strict=True)]


def write_token_files(docs: DataFrame, path: str, out: str, end_id: int = 0) -> None:
    """Encodes all texts by a file of the tokenizers library and writes segments under out.

    A row is (part, segment, n_tokens, doc_ids, payload); part and segment order the rows by doc_id.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary, part = ids_of(path), TaskContext.get().partitionId()
        end = np.array([end_id], "<u4").tobytes()
        number = size = 0
        ids: list = []
        held: list[np.ndarray] = []

        def row() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), pa.array([number], pa.int32()), pa.array([size], pa.int64()), pa.array([ids], pa.list_(kept)), pa.array([encode_segment(held)], pa.binary())], ["part", "segment", "n_tokens", "doc_ids", "payload"])

        for b in batches:
            kept = b.column("doc_id").type
            for doc, text in zip(b.column("doc_id").to_pylist(), b.column("text").to_pylist(), strict=True):
                held.append(np.frombuffer(vocabulary.of(text) + end, "<u4"))
                ids.append(doc)
                size += len(held[-1])
                if size >= SEGMENT:
                    yield row()
                    number, size, ids, held = number + 1, 0, [], []
        if held:
            yield row()

    # rows that share an id, or have none, are dealt by how their texts begin
    ordered = docs.select("doc_id", "text").repartitionByRange(F.asc_nulls_first("doc_id"), F.asc_nulls_first(F.substring("text", 1, 32))).sortWithinPartitions(F.asc_nulls_first("doc_id"), "text")
    ordered.mapInArrow(run, f"part int, segment int, n_tokens long, doc_ids array<{kind}>, payload binary").write.option("compression", "none").parquet(out)


def read_token_files(files: DataFrame) -> DataFrame:
    """Documents of files written by write_token_files: (doc_id, start, n_tokens, ids binary).

    start counts the ids of all documents before. Segments decode one by one wherever they lie.
    """
    kind = files.schema["doc_ids"].dataType.elementType.simpleString()
    sizes = files.select("part", "segment", "n_tokens")
    parts = sizes.groupBy("part").agg(F.sum("n_tokens").alias("n"))
    ahead = parts.select(F.col("part").alias("_p"), (F.sum("n").over(Window.orderBy("part")) - F.col("n")).alias("_n"))
    starts = sizes.join(ahead, F.col("part") == F.col("_p")).select(F.col("part").alias("_part"), F.col("segment").alias("_segment"), (F.col("_n") + F.sum("n_tokens").over(Window.partitionBy("part").orderBy("segment")) - F.col("n_tokens")).alias("first"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for k in range(b.num_rows):
                docs = decode_segment(b.column("payload")[k].as_py())
                n = np.array([len(d) for d in docs], np.int64)
                start = b.column("first")[k].as_py() + np.cumsum(n) - n
                yield pa.RecordBatch.from_arrays([b.column("doc_ids")[k].values, pa.array(start), pa.array(n), pa.array([d.astype("<u4").tobytes() for d in docs], pa.binary())], ["doc_id", "start", "n_tokens", "ids"])

    placed = files.join(starts, (F.col("part") == F.col("_part")) & (F.col("segment") == F.col("_segment"))).select("doc_ids", "payload", "first")
    return placed.mapInArrow(run, f"doc_id {kind}, start long, n_tokens long, ids binary")

"""Byte-pair encoding over fragments between certain cuts, and decoding.

A merge makes a token that holds the two bytes at its seam. So where a byte pair lies inside no
token of the vocabulary, no merge ever spans it, and the text on both sides can be encoded
independently. Such cuts part nearly all words, as letters and the space after them meet in no
token. Fragments repeat far more than texts do: each batch encodes its distinct ones, and each
Python worker keeps a bounded number of them. New words of Latin letters take their merges in NumPy, many
in step; the library encodes all other fragments. Rows are dealt evenly over tasks first: one task reads a
row group of a file, however large, and encoding a text costs far more than moving it.

The pre-tokenizer looks at characters, not at merges, so a cut counts only where it can't change
what that sees: between two characters, neither an ASCII apostrophe, the first no white space. (A run of
white space is split by what follows it; a contraction by what begins it.) The first is one of ASCII or of
two bytes from U+00C0 on, where no white space is, the second any. Pairs inside the contractions and the names of added tokens count as joined. Files with a normalizer, a prefix space or
another pre-tokenizer have no certain cuts here, nor have such with an added token of letters alone: their texts are encoded whole.

Defined results: a null or empty text has no ids; null ids, and ids that no token has, decode to nothing;
bytes that aren't UTF-8 decode to U+FFFD; other columns pass through, but one with the name of
a result is replaced; repeated rows are rows of their own; an empty table gives no rows. Texts are
encoded whole, whatever their length, each in the memory of one task.
"""

from __future__ import annotations

import json
import os
import struct
from collections.abc import Iterator
from functools import cached_property

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from tokenizers import Tokenizer

from .lm import flat_texts
from .tokens import byte_alphabet

#: Fragments that one Python worker keeps, and the longest of them in bytes.
CACHE, LONGEST = 300_000, 64
#: Bytes of text cut at once, about: the more, the fewer fragments are distinct.
CHUNK = 1 << 23
# The contractions of the byte-level pre-tokenizer, and the white space that it knows among ASCII bytes
# (with the separators that only some libraries count).
CONTRACTIONS = ("'s", "'t", "'re", "'ve", "'m", "'ll", "'d")
BLANKS = (0x20, *range(0x09, 0x0E), *range(0x1C, 0x20))

#: Letters below this character are letters to every version of Unicode's tables.
LATIN = "\u0250"

#: Longest words that are merged side by side, in groups by length, and how many words at once.
LENGTHS, WORDS = (8, 16, 32, 64), 1 << 15
#: Bytes of letters that take two bytes or one: ASCII, and U+00C0 to U+023F but for the two signs among them.
LETTERS = np.zeros(256, bool)
LETTERS[[*range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0xC0), *range(0xC3, 0xC9)]] = True
SIGNS = (0xC397, 0xC3B7)
NONE = np.iinfo(np.int32).max

_held: dict[str, "Codec"] = {}


def token_bytes(told: dict) -> list[bytes]:
    """The bytes that each id stands for, by the byte-level alphabet; ids without a token stand for nothing."""
    back = {c: b for b, c in byte_alphabet().items()}
    names = {i: name for name, i in told["model"]["vocab"].items()} | {t["id"]: t["content"] for t in told["added_tokens"]}
    out = [b""] * (max(names, default=-1) + 1)
    for i, name in names.items():
        known = [back.get(c) for c in name]
        out[i] = name.encode() if None in known else bytes(known)
    return out


def joined_pairs(tokens: list[bytes]) -> np.ndarray:
    """For each byte pair (a, b), at a * 256 + b, whether it lies inside a token."""
    raw = np.frombuffer(b"".join(tokens), np.uint8).astype(np.int64)
    ends = np.cumsum([len(t) for t in tokens])
    inside = np.ones(max(len(raw) - 1, 0), bool)
    seams = ends[(ends > 0) & (ends < len(raw))] - 1
    inside[seams] = False
    table = np.zeros(1 << 16, bool)
    table[(raw[:-1] * 256 + raw[1:])[inside]] = True
    return table


def forced_cuts(tokens: list[bytes]) -> np.ndarray:
    """For each byte pair, whether a cut between the two is certain for merges and pre-tokenizer alike.

    A first byte from 0x80 to 0xBF must end a character of two bytes from U+00C0 on, which the pair can't tell.
    """
    at = np.arange(1 << 16)
    first, second = at >> 8, at & 255
    begins = (second < 0x80) | (second >= 0xC2)
    plain = (first < 0xC0) & begins & (first != 0x27) & (second != 0x27) & ~np.isin(first, BLANKS)
    return plain & ~joined_pairs([*tokens, *(c.encode() for c in CONTRACTIONS)])


class Merges:
    """The merges of a byte-level vocabulary, as a hash table with linear probing of its pairs of ids."""

    def __init__(self, model: dict, alphabet: dict[int, str]):
        vocab = model["vocab"]
        self.bytes = np.array([vocab[alphabet[b]] for b in range(256)], np.int64)
        told = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        ranks = {vocab[a] << 32 | vocab[b]: k for k, (a, b) in enumerate(told)}
        self.made = np.array([vocab[a + b] for a, b in told] or [0], np.int64)
        keys, of = np.fromiter(ranks, np.uint64, len(ranks)), np.fromiter(ranks.values(), np.int32, len(ranks))
        self.bits = max(4, (4 * len(keys)).bit_length())
        self.keys, self.ranks = np.full(1 << self.bits, ~np.uint64(0)), np.full(1 << self.bits, NONE, np.int32)
        slots, left = self.slots(keys), np.arange(len(keys))
        while len(left):
            free = left[self.keys[slots[left]] == ~np.uint64(0)]
            taken, first = np.unique(slots[free], return_index=True)
            self.keys[taken], self.ranks[taken] = keys[free[first]], of[free[first]]
            left = np.setdiff1d(left, free[first])
            slots[left] = slots[left] + 1 & (1 << self.bits) - 1

    def slots(self, keys: np.ndarray) -> np.ndarray:
        return (keys * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(64 - self.bits)).astype(np.int64)

    def rank(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """The rank of the merge of each pair of ids; NONE where there is none."""
        keys = (a << 32 | b).astype(np.uint64)
        slots = self.slots(keys)
        met = self.keys[slots]
        out = np.where(met == keys, self.ranks[slots], NONE)
        far = np.flatnonzero((met != keys) & (met != ~np.uint64(0)))
        while len(far):
            slots[far] = slots[far] + 1 & (1 << self.bits) - 1
            met = self.keys[slots[far]]
            out[far] = np.where(met == keys[far], self.ranks[slots[far]], NONE)
            far = far[(met != keys[far]) & (met != ~np.uint64(0))]
        return out

    def merged(self, raw: np.ndarray, begins: np.ndarray, sizes: np.ndarray, longest: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids of words of raw, one after the other, and how many each has. In each step each word does its first merge of least rank."""
        n, place = len(begins), np.arange(longest)[:, None]
        inside = place < sizes
        ids = np.where(inside, self.bytes[raw[np.where(inside, begins + place, 0)]], -1)
        after, before = np.repeat(place + 1, n, 1), np.repeat(place - 1, n, 1)
        least = np.full((longest, n), NONE << 8, np.int64)  # rank and place of the pair that begins here
        pairs = inside[1:]
        least[:-1][pairs] = self.rank(ids[:-1][pairs], ids[1:][pairs]).astype(np.int64) << 8 | np.broadcast_to(place[:-1], pairs.shape)[pairs]
        while True:
            best = least.min(axis=0)
            word = np.flatnonzero(best < NONE << 8)
            if not len(word):
                break
            rank, at = best[word] >> 8, best[word] & 255
            gone, left = after[at, word], before[at, word]
            right = after[gone, word]
            ids[at, word] = new = self.made[rank]
            ids[gone, word], least[gone, word], least[at, word], after[at, word] = -1, NONE << 8, NONE << 8, right
            has = np.flatnonzero(right < sizes[word])
            w, k, r = word[has], at[has], right[has]
            before[r, w] = k
            least[k, w] = self.rank(new[has], ids[r, w]).astype(np.int64) << 8 | k
            has = np.flatnonzero(left >= 0)
            w, k = word[has], left[has]
            least[k, w] = self.rank(ids[k, w], new[has]).astype(np.int64) << 8 | k
        ids = ids.T
        return ids[ids >= 0], (ids >= 0).sum(axis=1)


class Codec:
    """A tokenizer file with its cuts, its tokens' bytes and the fragments met so far."""

    def __init__(self, path: str):
        self.path = path
        with open(path, encoding="utf-8") as f:
            told = json.load(f)
        tokens, steps = token_bytes(told), told["pre_tokenizer"] or {}
        plain = steps.get("type") == "ByteLevel" and steps.get("use_regex", True) and not steps.get("add_prefix_space") and not told["normalizer"]
        model = told["model"]
        plain = plain and model["type"] == "BPE" and not any(model.get(k) for k in ("dropout", "continuing_subword_prefix", "end_of_word_suffix", "byte_fallback"))
        whole = not any(t[k] for t in told["added_tokens"] for k in ("single_word", "lstrip", "rstrip", "normalized"))
        whole = whole and not any((t["content"].strip(" \n") or "a").isalpha() for t in told["added_tokens"])  # words go to the merges alone
        self.cuts = forced_cuts(tokens) if plain and whole else np.zeros(1 << 16, bool)
        self.cut = bool(self.cuts.any())
        self.tokens = pa.array([*tokens, b""], pa.large_binary())
        self.byte_level = (told["decoder"] or {}).get("type") == "ByteLevel"
        self.alphabet = byte_alphabet()
        self.space = self.alphabet[0x20]
        self.known: dict[bytes, bytes] = {}
        self.merges = Merges(model, self.alphabet) if self.cut and not model.get("ignore_merges") and model["vocab"].keys() >= {*self.alphabet.values()} else None

    @cached_property
    def tokenizer(self) -> Tokenizer:
        """The library's tokenizer. Decoding mostly does without it."""
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        loaded = Tokenizer.from_file(self.path)
        loaded.no_truncation()
        loaded.no_padding()
        return loaded

    @cached_property
    def model(self):
        return self.tokenizer.model

    def fragments(self, raw: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Where fragments begin and the last ends; they don't cross texts, whose bounds are at."""
        pairs = raw[:-1].astype(np.uint16) << np.uint16(8) | raw[1:] if len(raw) else np.zeros(0, np.uint16)
        cut = np.zeros(len(raw) + 1, bool)
        cut[1:-1] = self.cuts[pairs]
        after = np.ones(len(cut), bool)  # ASCII before the cut, or a lead byte of two-byte characters before that
        after[1:-1] = raw[:-1] < 0x80
        after[2:-1] |= (raw[:-2] >= 0xC3) & (raw[:-2] < 0xE0)
        cut &= after
        cut[at] = True
        return np.flatnonzero(cut)

    def new_ids(self, fragment: str) -> list[int]:
        """Ids of a fragment from the library; by its merges alone where it is one word, which the pre-tokenizer leaves whole, or that after one line's end."""
        word = fragment[1:] if fragment[0] in " \n" else fragment
        if self.cut and word.isalpha() and max(word) < LATIN:
            if fragment[0] == "\n":
                return self.new_ids("\n") + self.new_ids(word)
            spelled = fragment.replace(" ", self.space) if word.isascii() else fragment.encode().decode("latin-1").translate(self.alphabet)
            return [t.id for t in self.model.tokenize(spelled)]
        return self.tokenizer.encode(fragment, add_special_tokens=False).ids

    def fragment_ids(self, distinct: pa.Array) -> list[bytes]:
        """Ids of distinct fragments as little-endian unsigned 32-bit integers."""
        raw, at = flat_texts(distinct.view(pa.large_string()))
        whole, ends = raw.tobytes(), at.tolist()
        fragments = [whole[a:b] for a, b in zip(ends, ends[1:], strict=False)]  # to_pylist() takes ten times as long
        found = list(map(self.known.get, fragments))
        new = [i for i, ids in enumerate(found) if ids is None]
        self.merge_words(raw, at, np.array(new, np.int64), found)
        for i in new:
            if found[i] is None:
                ids = self.new_ids(fragments[i].decode())
                found[i] = struct.pack(f"<{len(ids)}I", *ids)
            if len(self.known) < CACHE and len(fragments[i]) <= LONGEST:
                self.known[fragments[i]] = found[i]
        return found

    def merge_words(self, raw: np.ndarray, at: np.ndarray, new: np.ndarray, found: list[bytes | None]) -> None:
        """Finds the ids of those of the new fragments that are one word of Latin letters, perhaps after a space: the pre-tokenizer leaves them whole."""
        if self.merges is None or not len(new):
            return
        sizes = np.diff(at)
        plain = LETTERS[raw]
        plain[at[:-1]] |= (raw[at[:-1]] == 0x20) & (sizes > 1)
        plain[1:] &= ~np.isin(raw[:-1].astype(np.uint16) << np.uint16(8) | raw[1:], SIGNS)
        new = new[np.logical_and.reduceat(plain, at[:-1])[new]]
        for least, most in zip((0, *LENGTHS), LENGTHS, strict=False):
            group = new[(sizes[new] > least) & (sizes[new] <= most)]
            for words in np.array_split(group, -(-len(group) // WORDS)) if len(group) else ():
                ids, n = self.merges.merged(raw, at[words], sizes[words], most)
                told, ends = ids.astype("<u4").tobytes(), [0, *(np.cumsum(n) * 4).tolist()]
                for i, a, b in zip(words.tolist(), ends, ends[1:], strict=False):
                    found[i] = told[a:b]

    def encode(self, texts: pa.Array) -> pa.Array:
        """Lists of ids of texts."""
        raw, at = flat_texts(texts)
        bounds = self.fragments(raw, at)
        parts = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(bounds) - 1, [None, pa.py_buffer(bounds.astype(np.int64)), pa.py_buffer(np.ascontiguousarray(raw))]) if len(raw) else pa.array([], pa.large_binary())
        distinct = parts.dictionary_encode()
        ids = pa.array(self.fragment_ids(distinct.dictionary), pa.large_binary()).take(distinct.indices)
        _, offsets, data = ids.buffers()
        offsets = np.frombuffer(offsets, np.int64)[: len(ids) + 1] if len(ids) else np.zeros(1, np.int64)
        flat = np.frombuffer(data, "<u4", int(offsets[-1]) // 4) if len(ids) else np.zeros(0, "<u4")
        of_texts = offsets[np.searchsorted(bounds, at)] // 4 if len(raw) else np.zeros(len(texts) + 1, np.int64)
        return pa.LargeListArray.from_arrays(pa.array(of_texts), pa.array(flat.view("<i4")))

    def decode(self, lists: pa.Array) -> pa.Array:
        """The texts that lists of ids stand for."""
        if not self.byte_level:
            return pa.array([self.tokenizer.decode([i for i in ids or () if i is not None and i >= 0], skip_special_tokens=False) for ids in lists.to_pylist()], pa.large_string())
        lists = lists.cast(pa.large_list(pa.int64()))
        at = np.concatenate([[0], np.cumsum(lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False))]).astype(np.int64)
        ids = lists.flatten().fill_null(-1).to_numpy(zero_copy_only=False)
        last = len(self.tokens) - 1
        told = self.tokens.take(pa.array(np.where((ids >= 0) & (ids < last), ids, last)))
        _, offsets, data = told.buffers()
        ends = np.frombuffer(offsets, np.int64)[at] if len(told) else np.zeros(len(at), np.int64)
        joined = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(lists), [None, pa.py_buffer(ends), data if data is not None else pa.py_buffer(b"")])
        try:
            return joined.cast(pa.large_string())
        except pa.ArrowInvalid:
            return pa.array([b.decode("utf-8", "replace") for b in joined.to_pylist()], pa.large_string())


def codec(path: str) -> Codec:
    """The process's codec for a file."""
    if path not in _held:
        _held[path] = Codec(path)
    return _held[path]


#: What a conversion gives, for Spark and for Arrow.
KINDS = {"encode": (T.ArrayType(T.IntegerType()), pa.list_(pa.int32())), "decode": (T.StringType(), pa.string())}


def _mapped(df: DataFrame, column: str, steps: dict[str, str], path: str) -> DataFrame:
    """df with what the codec makes of a column. steps: conversions by the name of their result, each of what the one before gave; texts give way to their ids."""
    given = {*steps, column} if "encode" in steps.values() else {*steps}
    kept = [f for f in df.schema.fields if f.name not in given]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made = codec(path)
        for b in batches:
            value = b.column(b.schema.get_field_index(column))
            low, sizes = 0, np.cumsum(_sizes(value))
            while low < b.num_rows:
                upto = (sizes[low - 1] if low else 0) + CHUNK
                high = max(low + 1, int(np.searchsorted(sizes, upto, side="right")))
                piece = b.slice(low, high - low)
                results = [piece.column(piece.schema.get_field_index(column))]
                for convert in steps.values():
                    results.append(getattr(made, convert)(results[-1]).cast(KINDS[convert][1]))
                yield pa.RecordBatch.from_arrays([*(piece.column(piece.schema.get_field_index(f.name)) for f in kept), *results[1:]], [*(f.name for f in kept), *steps])
                low = high

    return df.mapInArrow(run, T.StructType([*kept, *(T.StructField(name, KINDS[convert][0]) for name, convert in steps.items())]))


def _sizes(values: pa.Array) -> np.ndarray:
    """Bytes of each text, or of each list's ids."""
    lengths = pc.binary_length(values) if pa.types.is_string(values.type) or pa.types.is_large_string(values.type) else pc.multiply(pc.list_value_length(values), 4)
    return lengths.fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)


def dealt(docs: DataFrame) -> DataFrame:
    """Rows spread evenly over tasks, by their place: a hash of ids or texts would gather equal ones. Without adaptive execution Spark ignores the hint."""
    place = "_place of a row"
    placed, key = docs.withColumn(place, F.monotonically_increasing_id()), F.col(f"`{place}`")
    adaptive = docs.sparkSession.conf.get("spark.sql.adaptive.enabled") == "true"
    return (placed.hint("rebalance", key) if adaptive else placed.repartition(key)).drop(place)


def encode(docs: DataFrame, path: str, text: str = "text", out: str = "ids") -> DataFrame:
    """Puts ids (array<int>) in the place of a text column: those of Tokenizer.encode(text, add_special_tokens=False).ids.

    path: a tokenizers file that every executor can open.
    """
    return _mapped(dealt(docs), text, {out: "encode"}, path)


def decode(docs: DataFrame, path: str, ids: str = "ids", out: str = "text") -> DataFrame:
    """Adds the text of a column of ids: that of Tokenizer.decode(ids, skip_special_tokens=False)."""
    return _mapped(docs, ids, {out: "decode"}, path)


def round_trip(docs: DataFrame, path: str, text: str = "text", ids: str = "ids", out: str = "text") -> DataFrame:
    """decode(encode(docs)) in one pass: ids, and the text that they decode to. Between the two, ids needn't leave the Python worker and come back."""
    return _mapped(dealt(docs), text, {ids: "encode", out: "decode"}, path)

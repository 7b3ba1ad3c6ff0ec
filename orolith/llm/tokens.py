"""Token ids of whole texts, with caches of the words and pieces already met.

A text is cut where a single space stands between two characters that aren't white
space. No pre-tokenizer of the supported files joins what such a cut parts, so each
part has the ids that it has in its text. A comma or full stop between a letter or digit
and a space is a part too, so a word isn't cached once more with each mark. A part new to the
process is normalized by the library, split by the file's own pattern, and its pieces get
their ids from the library's BPE model. Texts for which the cuts aren't certain, and
those that hold the name of an added token, go to the library whole, so all ids are those
of Tokenizer.encode(text, add_special_tokens=False).
"""

from __future__ import annotations

import gc
import json
import os
import re
import unicodedata

import numpy as np
import regex
from tokenizers import Tokenizer

#: Parts, and pieces of parts that have several, that one process keeps; others come from the library each time.
CACHE, PIECES = 1_000_000, 200_000
#: The split of the byte-level pre-tokenizer where a file names none.
BYTE_LEVEL = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
_held: dict[str, "Ids"] = {}


def byte_alphabet() -> dict[int, str]:
    """The printable character that stands for each byte in byte-level vocabularies."""
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in set(printable)]
    return {b: chr(b) for b in printable} | {b: chr(256 + i) for i, b in enumerate(others)}


class Ids(dict):
    """Maps parts to their ids as little-endian unsigned 32-bit integers."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        gc.set_threshold(200_000, 20, 100)  # collections walk the caches, which hold no cycles
        self.tokenizer = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            told = json.load(f)
        steps = told["pre_tokenizer"]
        self.added = [t["content"] for t in told["added_tokens"]]
        self.hard = any(t["normalized"] for t in told["added_tokens"])  # their names would have to be sought in normalized texts
        patterns = [x["pattern"]["Regex"] for x in steps.get("pretokenizers", []) if x["type"] == "Split"]
        self.find = regex.compile(patterns[0] if patterns else BYTE_LEVEL).findall
        self.spaced = not patterns  # a space belongs to the part after it
        self.alphabet = byte_alphabet()
        self.lowers = self.lowered()
        self.codes = [i.to_bytes(4, "little") for i in range(max(self.tokenizer.get_vocab(True).values(), default=-1) + 1)]
        self.pieces: dict[str, bytes] = {}
        for mark, sign in MARKS:
            self[sign] = self.model_ids(mark)

    def lowered(self) -> str:
        """The character below which the normalizer does to printable ones just what lower() does; empty if there is none.

        Latin letters only: none of them combines, and none depends on its neighbours.
        """
        normalizer, upto = self.tokenizer.normalizer, 0x21
        while normalizer and upto < 0x250 and (not chr(upto).isprintable() or normalizer.normalize_str(chr(upto)) == chr(upto).lower()):
            upto += 1
        return chr(upto) if upto > 0x21 else ""

    def whole(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def model_ids(self, piece: str) -> bytes:
        plain = piece.isascii() and piece.isprintable() and " " not in piece  # those characters stand for themselves
        return b"".join([self.codes[t.id] for t in self.tokenizer.model.tokenize(piece if plain else piece.encode().decode("latin-1").translate(self.alphabet))])

    def piece(self, piece: str) -> bytes:
        ids = self.pieces.get(piece)
        if ids is None:
            ids = self.model_ids(piece)
            if len(self.pieces) < PIECES:
                self.pieces[piece] = ids
        return ids

    def cut(self, part: str) -> bytes:
        if self.lowers and part.isprintable() and max(part) < self.lowers:
            part = part.lower()
        elif self.tokenizer.normalizer:
            part = self.tokenizer.normalizer.normalize_str(part)
        if part.lstrip(" ").isalpha():
            return self.model_ids(part)
        if part[-1] in ".,;:!?" and part[:-1].isalpha():  # letters never join such a mark
            return self.piece(part[:-1]) + self.piece(part[-1])
        return b"".join(map(self.piece, self.find(part)))

    def __missing__(self, part: str) -> bytes:
        if self.spaced:
            ids = self.piece("\n") + self.cut(part[1:]) if part[0] == "\n" else self.cut(f" {part}")
        else:
            ids = self.cut(part) if part else b""
        if len(self) < CACHE:
            self[part] = ids
        return ids

    def of(self, text: str | None) -> bytes:
        """The ids of a whole text; a null text has none."""
        if not text:
            return b""
        if self.hard or any(name in text for name in self.added) or any(sign in text for _, sign in MARKS):
            return self.whole(text)
        latin, marked = _latin(text), text
        if not self.spaced:  # white space has no ids
            for blank in "\n\t\r":
                marked = marked.replace(blank, " ")
        elif not BREAK(text):
            marked = marked.replace("\n", " \n")
        if latin:
            if text[0] not in ".," and not JOINED(marked):
                for mark, sign in MARKS:
                    marked = marked.replace(f"{mark} ", f" {sign} ")
            if self.lowers > "\xff":
                marked = marked.lower()
        parts = marked.split(" ")
        if text[0].isspace() or text[-1].isspace() or EDGE(text if self.spaced else marked) or self.spaced and "" in parts or not text.isascii() and (not latin or "\x85" in text or "\xa0" in text) and _uncertain(parts):
            return self.whole(text)
        first = self.cut(parts[0]) if self.spaced else self[parts[0]]
        return first + b"".join(map(self.__getitem__, parts[1:]))


#: Marks that are parts of their own before a space, and what stands for them there.
MARKS = ((",", "\x01"), (".", "\x02"))
#: Whether a text has such a mark after anything but a letter or digit.
JOINED = re.compile(r"[.,] (?<=[\W_][.,] )").search
#: ASCII white space next to a space: there the runs of white space matter. So they do around a line's end next to any white space.
EDGE = re.compile(r"[\t-\r\x1c-\x1f](?:(?<= .)| )", re.S).search
BREAK = re.compile(r"\n(?:\s|(?<=\s\n))").search


def _uncertain(parts: list[str]) -> bool:
    """Whether a part begins or ends with white space, or with a mark that joins what is before it."""
    return any(p[0].isspace() or p[-1].isspace() or unicodedata.combining(p[0]) for p in parts if p and not p.isascii())


def _latin(text: str) -> bool:
    """Whether no character is beyond U+00FF: there the case of a letter depends on nothing else."""
    try:
        return text.isascii() or bool(text.encode("latin-1"))
    except UnicodeEncodeError:
        return False


def ids_of(path: str) -> Ids:
    """The process's tokenizer and cache for a file."""
    if path not in _held:
        _held[path] = Ids(path)
    return _held[path]

"""Byte-pair encoding between certain cuts, against the unmodified library."""

import hashlib
import json

import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from orolith.llm import bpe, queries

PATH = public_tokenizers.path("byte_bpe_50k.json")
SF = "/root/testdata/sf0.001"
PARTS = ["'", "s", "'s", "'ll", "'re", " ", "  ", "\t", "\n", "\r\n", "a", "b", "Z", "zq", "é", "ß", "中", "文", "🙂", "\xa0", "　", "\x1c", "\x85", "1", "23", ".", "..", "!", "<|endoftext|>", "<|", "|>", "́", "ll", "re", "ve", "the", "\x00"]
LIBRARY = Tokenizer.from_file(PATH)


@pytest.fixture(scope="module")
def library():
    return LIBRARY


@settings(max_examples=400, deadline=None)
@given(st.lists(st.one_of(st.lists(st.sampled_from(PARTS), max_size=14).map("".join), st.text(max_size=20)), max_size=6))
def test_texts_of_marks_and_blanks(texts):
    codec, library = bpe.codec(PATH), LIBRARY
    ids = codec.encode(pa.array(texts, pa.string())).to_pylist()
    assert ids == [library.encode(t, add_special_tokens=False).ids for t in texts]
    assert codec.decode(pa.array(ids, pa.list_(pa.int32()))).to_pylist() == [library.decode(i, skip_special_tokens=False) for i in ids]


def test_any_ids_decode(library):
    rng = np.random.default_rng(3)
    lists = rng.integers(0, 50257, (500, 7)).tolist()
    assert bpe.codec(PATH).decode(pa.array(lists)).to_pylist() == [library.decode(i, skip_special_tokens=False) for i in lists]
    odd = pa.array([[-1, 50257, 13, None], None, []], pa.list_(pa.int64()))
    assert bpe.codec(PATH).decode(odd).to_pylist() == [library.decode([13]), "", ""]


def test_cuts_lie_in_no_token():
    with open(PATH, encoding="utf-8") as f:
        tokens = bpe.token_bytes(json.load(f))
    cuts = bpe.forced_cuts(tokens)
    assert not any(cuts[a * 256 + b] for t in tokens for a, b in zip(t, t[1:], strict=False))
    assert cuts[ord("e") * 256 + ord(" ")] and not cuts[ord(" ") * 256 + ord("e")] and not cuts[ord("t") * 256 + ord("h")]


def test_small_vocabulary(tmp_path):
    """A vocabulary with few merges has cuts inside words, and contractions without tokens of their own."""
    alphabet = bpe.byte_alphabet()
    merges = [("t", "h"), ("th", "e"), ("l", "l"), ("Ġ", "a"), ("'", "r")]
    names = [*alphabet.values(), *("".join(m) for m in merges)]
    step = {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": True}
    model = {"type": "BPE", "dropout": None, "unk_token": None, "continuing_subword_prefix": None, "end_of_word_suffix": None, "fuse_unk": False, "byte_fallback": False, "ignore_merges": False, "vocab": {n: i for i, n in enumerate(names)}, "merges": [list(m) for m in merges]}
    path = tmp_path / "small.json"
    path.write_text(json.dumps({"version": "1.0", "truncation": None, "padding": None, "added_tokens": [], "normalizer": None, "pre_tokenizer": step, "post_processor": None, "decoder": step, "model": model}))
    library, codec = Tokenizer.from_file(str(path)), bpe.Codec(str(path))
    rng = np.random.default_rng(5)
    texts = ["".join(rng.choice(["t", "h", "e", "l", "'", "r", "s", "ll", "'re", " ", "a", "\n", "1", ".", "é"], rng.integers(0, 16))) for _ in range(5000)]
    assert codec.encode(pa.array(texts)).to_pylist() == [library.encode(t, add_special_tokens=False).ids for t in texts]
    whole = bpe.Codec(public_tokenizers.path("word_bpe_49k.json"))
    assert not whole.cut and whole.encode(pa.array(["The  Cat's"])).to_pylist()[0] == whole.tokenizer.encode("The  Cat's", add_special_tokens=False).ids


def test_query(spark, library):
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    found = queries.op13_bpe(spark, SF).collect()
    assert len(found) == len(texts)
    for r in found:
        ids = library.encode(texts[r["doc_id"]] or "", add_special_tokens=False).ids
        assert r["n_tokens"] == len(ids) and r["ids_sha256"] == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256(library.decode(ids, skip_special_tokens=False).encode()).hexdigest()


def test_odd_rows(spark, library):
    long = "the cat's  " * 300_000
    rows = [(1, None, "x"), (1, None, "x"), (None, "", None), (2, long, "y")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, ids string")
    encoded = bpe.encode(docs, PATH)
    assert encoded.columns == ["doc_id", "ids"]
    found = sorted(bpe.decode(encoded, PATH).collect(), key=str)
    assert [(r["doc_id"], len(r["ids"]), r["text"]) for r in found] == [(1, 0, ""), (1, 0, ""), (2, len(library.encode(long, add_special_tokens=False).ids), long), (None, 0, "")]
    assert bpe.decode(bpe.encode(docs.limit(0), PATH), PATH).count() == 0


def test_added_token_of_letters(tmp_path):
    with open(PATH, encoding="utf-8") as f:
        told = json.load(f)
    told["added_tokens"].append(told["added_tokens"][0] | {"id": 50257, "content": "PAD"})
    path = tmp_path / "pad.json"
    path.write_text(json.dumps(told))
    texts = ["a PADs", "xPADy PAD", "the cat"]
    assert bpe.Codec(str(path)).encode(pa.array(texts)).to_pylist() == [Tokenizer.from_file(str(path)).encode(t, add_special_tokens=False).ids for t in texts]


def test_words_merged_side_by_side(library):
    """New words take their merges in NumPy, all others go to the library."""
    rng, asked = np.random.default_rng(7), []
    parts = [*"etaonihsrdlu", "th", "tion", "ing", "É", "ß", "ſ", "ș", "ƿ", "×", "÷", "ª", "ɐ", "中"]
    words = ["".join(rng.choice(parts, rng.integers(1, 40), p=[0.06] * 15 + [0.0095] * 5 + [0.0105] * 5)) for _ in range(4000)] + ["e" * 63, "e" * 64, "e" * 65, "th" * 400]
    codec = bpe.Codec(PATH)
    codec.new_ids = lambda fragment, ask=codec.new_ids: asked.append(fragment) or ask(fragment)
    texts = [w if k % 3 else f"{w} {w}" for k, w in enumerate(words)] + ["", " ", "\n the"]
    assert codec.encode(pa.array(texts)).to_pylist() == [library.encode(t, add_special_tokens=False).ids for t in texts]
    assert not any(f.isascii() and f.lstrip(" ").isalpha() and len(f) <= 64 for f in asked)
    assert any("×" in f for f in asked) and any("÷" in f for f in asked) and "th" * 400 in asked and len(asked) < 2500


def test_rows_of_one_task_are_dealt(spark, library):
    """A row group is read by one task, however large; equal rows aren't gathered either."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        docs = spark.createDataFrame([(1, "the cat's  ")] * 400, "doc_id long, text string").coalesce(1)
        found = bpe.encode(docs, PATH).withColumn("task", F.spark_partition_id()).collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert [tuple(r["ids"]) for r in found] == [tuple(library.encode("the cat's  ", add_special_tokens=False).ids)] * 400
    sizes = np.unique([r["task"] for r in found], return_counts=True)[1]
    assert len(sizes) == 4 and sizes.max() < 200


def test_rows_are_dealt_without_adaptive_execution(spark):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        docs = spark.createDataFrame([(1, "the cat's  ")] * 400, "doc_id long, text string").coalesce(1)
        found = bpe.encode(docs, PATH).groupBy(F.spark_partition_id()).count().collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
    assert len(found) == 4 and sum(r["count"] for r in found) == 400


def test_one_pass(spark):
    """One pass gives what encode() and then decode() give, by one Python step."""
    rows = [(1, None, "x"), (1, None, "x"), (None, "", None), (2, "the cat's  \nÉté × 中", "y")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, ids string")
    both, one = bpe.decode(bpe.encode(docs, PATH), PATH), bpe.round_trip(docs, PATH)
    assert one.schema == both.schema and sorted(one.collect(), key=str) == sorted(both.collect(), key=str)
    assert bpe.round_trip(docs, PATH, out="back").columns == ["doc_id", "ids", "back"] and bpe.round_trip(docs.limit(0), PATH).count() == 0
    assert queries.op13_bpe(spark, SF)._jdf.queryExecution().executedPlan().toString().count("MapInArrow") == 1

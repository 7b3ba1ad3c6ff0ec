"""Training-data operators against brute force, round trips and edge cases."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import duckdb
import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest
import xxhash
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from orolith.llm import chat, common, embeddings, html, lm, mixing, packing, quality, queries, rangecoder, sharding, simhash, tokens

SF = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars long"
LONG = "word " * 60_000
#: Nulls in any column, empty and very long texts, ties and repeated rows.
ODD = [(1, None, None, None, None), (None, "a b c d e", "en", "s", 9), (2, "", "en", "", 0), (3, " \n\t ", "xx", "s", 4), (4, LONG, "en", "s", 1), (4, LONG, "en", "s", 1), (5, "one", "en", None, 3), (5, "two", "en", None, 3), (6, "éè ퟿ \U0001f600 x y", "fr", "s", 1)]


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame(ODD, DOCS)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], DOCS)


@pytest.fixture(scope="module")
def docs(spark):
    return {r["doc_id"]: r for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}


def union_find(nodes, links):
    root = {n: n for n in nodes}

    def find(n):
        while root[n] != n:
            n = root[n]
        return n

    for a, b in links:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def test_components(spark):
    rng = random.Random(1)
    edges = [(rng.randrange(400), rng.randrange(400)) for _ in range(300)] + [(1000 + i, 1001 + i) for i in range(60)] + [(2000, 2000 + i) for i in range(80)] + [(7, 7)]
    got = {r["node"]: r["component"] for r in common.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    want = union_find({n for e in edges for n in e}, edges)
    assert all(got.get(n, n) == c for n, c in want.items())
    assert common.components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_forest():
    rng = np.random.default_rng(2)
    a, b = rng.integers(0, 300, 250), rng.integers(0, 300, 250)
    nodes, roots = common.forest(a, b)
    want = union_find(set(a.tolist()) | set(b.tolist()), zip(a.tolist(), b.tolist(), strict=True))
    got = dict(zip(nodes.tolist(), roots.tolist(), strict=True))
    assert all(got.get(n, n) == c for n, c in want.items())


# 1 embeddings


def vectors(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")


def test_op1_against_brute_force(spark):
    rng = np.random.default_rng(3)
    base = rng.standard_normal((300, 16))
    near = base[:40].repeat(4, 0) + 0.05 * rng.standard_normal((160, 16))
    group = base[50] + 0.03 * rng.standard_normal((150, 16))
    x = np.concatenate([base, near, group, base[:5], base[7:8] * 3]).astype(np.float32)
    rows = [(i, v.tolist(), 0) for i, v in enumerate(x)]
    got = {r["vec_id"]: r for r in embeddings.near_duplicates(vectors(spark, rows), shards=3).collect()}
    u = embeddings.unit(x.astype(float))
    linked = u @ u.T >= 0.95
    np.fill_diagonal(linked, False)
    found = sum(got[i]["n_links"] for i in range(len(x)))
    assert all(got[i]["n_links"] <= n for i, n in enumerate(linked.sum(1))) and found >= 0.98 * linked.sum()
    want = union_find(range(len(x)), zip(*np.nonzero(linked), strict=True))
    assert sum(got[i]["component_id"] == c for i, c in want.items()) >= 0.99 * len(x)


@pytest.mark.parametrize(("dim", "groups"), [(64, 250), (768, 40)])
def test_op1_recall_at_the_threshold(spark, dim, groups, monkeypatch):
    """Chains and stars whose links lie at cosines 0.95 to 0.97, the hardest to reach, in shards bounded by bytes; large groups in parts."""
    rng = np.random.default_rng(dim)
    base = embeddings.unit(rng.standard_normal((groups, dim)))
    rows = [base]
    for cosine in rng.uniform(0.95, 0.97, 3):
        side = rng.standard_normal(base.shape)
        side = embeddings.unit(side - (side * base).sum(1)[:, None] * base)
        rows.append((cosine + 1e-6) * base + np.sqrt(1 - (cosine + 1e-6) ** 2) * side)
    x = np.concatenate([*rows, rng.standard_normal((4 * groups, dim))])
    frame = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    monkeypatch.setattr(embeddings, "PART", 3)
    got = {r["vec_id"]: r for r in embeddings.near_duplicates(frame, shards=2).collect()}
    u = embeddings.unit(x)
    linked = u @ u.T >= 0.95
    np.fill_diagonal(linked, False)
    want = union_find(range(len(x)), zip(*np.nonzero(linked), strict=True))
    assert linked.sum() >= 6 * groups
    assert sum(got[i]["n_links"] for i in want) >= 0.99 * linked.sum() and sum(got[i]["component_id"] == c for i, c in want.items()) >= 0.99 * len(x)
    assert all(got[i]["n_links"] == linked[i].sum() for i, c in want.items() if got[i]["component_id"] == c and sum(g["component_id"] == c for g in got.values()) == sum(w == c for w in want.values()))


def test_op1_sizes_of_vectors():
    big = np.array([[1e200, 1e200], [3e-200, 4e-200], [-5e300, 0]])
    assert embeddings.unit(big) == pytest.approx(np.array([[0.5**0.5, 0.5**0.5], [0.6, 0.8], [-1, 0]]))


def test_op1_edges(spark):
    rows = [(1, None, 0), (2, [0.0, 0.0], 0), (3, [1.0, None], 0), (4, [float("nan"), 1.0], 0), (5, [float("inf"), 1.0], 0), (6, [], 0), (7, [1.0, 0.0], None), (8, [1.0, 0.0], 1), (8, [1.0, 0.0], 1), (9, [1.0, 0.0, 0.0], 1), (None, [1.0, 0.0], 1), (10, [2.0, 0.01], 1)]
    got = {(r["vec_id"], i): (r["n_links"], r["component_id"], r["kept"]) for i, r in enumerate(embeddings.near_duplicates(vectors(spark, rows)).collect())}
    by = {}
    for (k, _), v in got.items():
        by.setdefault(k, v)
    assert len(got) == len(rows) and all(by[k] == (0, k, True) for k in (1, 2, 3, 4, 5, 6, 9))
    assert by[7] == (3, 7, True) and by[8] == (3, 7, False) and by[10] == (3, 7, False) and by[None] == (0, None, False)
    assert embeddings.near_duplicates(vectors(spark, [])).count() == 0


# 2 token files


@pytest.mark.parametrize("parts", [[], [[]], [[5]], [[1, 2, 3] * 4000, [], [70_000, 2**32 - 1, 0]], [list(range(50_000))], [[7] * 20_000]])
def test_segment_round_trip(parts):
    parts = [np.array(p, np.uint32) for p in parts]
    back = rangecoder.decode_segment(rangecoder.encode_segment(parts)) if parts else []
    assert len(back) == len(parts) and all((a == b).all() for a, b in zip(parts, back, strict=True))


def test_damage_is_found():
    data = bytearray(rangecoder.encode_segment([np.arange(9000, dtype=np.uint32) % 700]))
    data[-400] ^= 8
    with pytest.raises(ValueError):
        rangecoder.decode_segment(bytes(data))


def test_sound_blocks_outlive_damaged_ones():
    docs = [np.arange(n, dtype=np.uint32) % 977 for n in (3000, 1000, 5000, 0, 4000, 9)]
    data = rangecoder.encode_segment(docs)
    for at in (len(data) - 9000, len(data) - 200):
        harmed = bytearray(data)
        harmed[at] ^= 4
        ids, _, sound = rangecoder.decode_blocks(bytes(harmed))
        assert (~sound).sum() == 1
        for k, (want, got) in enumerate(zip(docs, rangecoder.salvage_segment(bytes(harmed)), strict=True)):
            low = sum(map(len, docs[:k]))
            whole = sound[low // rangecoder.BLOCK: -(-(low + len(want)) // rangecoder.BLOCK)].all()
            assert (got is not None) == whole and (got is None or (got == want).all())
    assert [len(d) for d in rangecoder.salvage_segment(data)] == [len(d) for d in docs]


def test_predictable_ids_cost_little():
    assert len(rangecoder.encode_segment([np.array(list(range(50)) * 800, np.uint32)])) < 40_000 * 0.12


def test_an_id_is_one_step_of_the_coder(monkeypatch):
    steps, put = [], rangecoder.Encoder.put
    monkeypatch.setattr(rangecoder.Encoder, "put", lambda self, *a: steps.append(len(a[0])) or put(self, *a))
    ids = np.random.default_rng(7).integers(0, 2**32, 3 * rangecoder.BLOCK, dtype=np.uint32)  # no guess is right
    assert (rangecoder.decode_segment(rangecoder.encode_segment([ids]))[0] == ids).all()
    assert len(steps) == rangecoder.BLOCK


def test_groups_of_blocks(monkeypatch):
    monkeypatch.setattr(rangecoder, "LANES", 2)
    docs = [np.random.default_rng(n).zipf(1.3, n).astype(np.uint32) for n in (5000, 0, 20_000, 1)]
    data = rangecoder.encode_segment(docs)
    assert all((a == b).all() for a, b in zip(docs, rangecoder.decode_segment(data), strict=True))
    harmed = bytearray(data)
    harmed[-9] ^= 1  # in the last block
    assert [d is not None for d in rangecoder.salvage_segment(bytes(harmed))] == [True, True, False, False]


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_cached_ids_equal_the_librarys(docs, name):
    ids, plain = tokens.ids_of(public_tokenizers.path(name)), Tokenizer.from_file(public_tokenizers.path(name))
    rnd = random.Random(3)
    mixed = ["".join(rnd.choice(["a", "B", "é", "ß", "İ", "²", "́", ",", ".", " ", " ", "5", "_", "\n", "\t", "\xa0", "\x01", "'s", "<|endoftext|>"]) for _ in range(rnd.randint(1, 14))) for _ in range(3000)]
    texts = [r["text"] for r in docs.values()] + mixed + ["a  b", "a \n b", " a", "a ", "x\ny z", "a ́b", "", "<|endoftext|> a", "it's don't 's b", "ΑΣ ΒΣ", "İ i", "ﬁ ½ 12 345", "a\x1c b", "  b", "A  b"]
    assert all(np.frombuffer(ids.of(t), "<u4").tolist() == plain.encode(t, add_special_tokens=False).ids for t in texts) and ids.of(None) == b""
    assert plain.token_to_id("<|endoftext|>") in np.frombuffer(ids.of("hello <|endoftext|> world"), "<u4")  # as the plain call has it


def check_token_files(spark, rows, frame, tmp_path):
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    rangecoder.write_token_files(frame, public_tokenizers.path("byte_bpe_50k.json"), str(tmp_path / "f"))
    got = sorted((tuple(r) for r in rangecoder.read_token_files(spark.read.parquet(str(tmp_path / "f"))).collect()), key=lambda r: r[1])
    want = sorted(((i is not None, i or 0, t or "", np.array([*tokenizer.encode(t or "", add_special_tokens=False).ids, 0], "<u4").tobytes()) for i, t in rows), key=lambda r: r[:3])
    at = 0
    for (known, i, _, ids), (doc, start, n, raw) in zip(want, got, strict=True):
        assert (doc if known else 0) == i and start == at and n == len(ids) // 4 and bytes(raw) == ids
        at += n


def test_op2(spark, docs, odd, empty, tmp_path, monkeypatch):
    check_token_files(spark, [(i, r["text"]) for i, r in docs.items()], spark.read.parquet(f"{SF}/documents.parquet"), tmp_path / "a")
    check_token_files(spark, [(r[0], r[1]) for r in ODD], odd, tmp_path / "b")
    check_token_files(spark, [], empty, tmp_path / "c")
    monkeypatch.setattr(rangecoder, "SEGMENT", 1000)
    check_token_files(spark, [(r[0], r[1]) for r in ODD], odd, tmp_path / "d")


# 3 sharding


def test_op3_law(spark):
    rows = queries.op3_sharding(spark, SF).collect()
    assert all(r["grown_shard"] in (r["shard"], 8) for r in rows) and {r["shard"] for r in rows} == set(range(8))
    assert 0 < sum(r["grown_shard"] == 8 for r in rows) < len(rows) / 4
    for s in range(8):
        assert sorted(r["slot"] for r in rows if r["shard"] == s) == list(range(sum(r["shard"] == s for r in rows)))
    texts = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    assert all(r["text_crc32"] == zlib.crc32(texts[r["doc_id"]].encode()) and r["size"] == len(texts[r["doc_id"]].encode()) + 1 for r in rows)


def test_op3_against_brute_force(spark):
    """Placement by the draws written out in Python, level by level, from hashlib."""
    rows = [(i,) for i in range(300)] + [(None,)]
    weights = {0: 2.0, 3: 0.5, 7: 4.0}
    tree = sharding.shard_tree(9, weights)

    def want(key):
        node = ""
        for level in range(3):
            kids = {}
            for leaf in tree:
                above = leaf[level - 1] if level else ""
                if str(above) == node:
                    kids[str(leaf[level])] = kids.get(str(leaf[level]), 0.0) + leaf[3]
            draw = lambda c: -math.log((int(hashlib.md5(f"{key}/{c}".encode()).hexdigest()[:12], 16) + 0.5) / 2**48) / kids[c]
            node = min(kids, key=draw)
        return int(node)

    got = sharding.assign_shards(spark.createDataFrame(rows, "doc_id long"), tree).collect()
    assert all(r["shard"] == want("null" if r["doc_id"] is None else r["doc_id"]) for r in got) and len({r["shard"] for r in got}) == 9


def test_op3_movement_stays_in_changed_subtrees(spark):
    ids = spark.range(4000).select(F.col("id").alias("doc_id"))
    heavy = sharding.shard_tree(8, {5: 3.0})
    moved = sharding.assign_shards(sharding.assign_shards(ids, sharding.shard_tree(8)), heavy, "after").where("shard <> after").collect()
    assert moved and all(4 <= r["after"] <= 7 for r in moved) and all(r["after"] == 5 for r in moved if r["shard"] in (4, 5))
    counts = {r["shard"]: r["n"] for r in sharding.assign_shards(ids, heavy).groupBy("shard").agg(F.count("*").alias("n")).collect()}
    assert counts[5] > 2 * counts[4]
    for n in range(8, 12):
        step = sharding.assign_shards(sharding.assign_shards(ids, sharding.shard_tree(n)), sharding.shard_tree(n + 1), "after")
        assert step.where(f"shard <> after AND after <> {n}").count() == 0


def test_op3_edges(odd, empty):
    rows = sharding.number_slots(sharding.assign_shards(odd, sharding.shard_tree(2))).collect()
    assert len(rows) == len(ODD)
    for s in (0, 1):
        assert sorted(r["slot"] for r in rows if r["shard"] == s) == list(range(sum(r["shard"] == s for r in rows)))
    assert sharding.number_slots(sharding.assign_shards(empty, sharding.shard_tree(8))).count() == 0


# 4, 8 and 10 against their SQL


@pytest.mark.parametrize("name", list(queries.SQL))
def test_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    result = con.execute(queries.SQL[name])
    names = [c[0] for c in result.description]
    found = queries.QUERIES[name](spark, SF)
    assert sorted(found.columns) == sorted(names)
    assert sorted((tuple(r) for r in found.select(*names).collect()), key=str) == sorted(result.fetchall(), key=str)


def test_op4_edges(odd, empty):
    rows = {r["doc_id"]: r for r in lm.backoff_scores(odd).collect()}
    assert rows[1]["score"] is None and rows[2]["n_pairs"] == 0 and rows[5]["score"] is None and rows[None]["n_pairs"] == 4
    assert rows[4]["score"] == pytest.approx(0, abs=1e-9)  # the copy vouches for it
    assert lm.backoff_scores(empty).count() == 0


def brute_backoff(texts):
    words = [(t or "").encode().split() for t in texts]
    grams = [[Counter(zip(w, w[1:], strict=False)), Counter(w), Counter(w[:-1])] for w in words]
    pairs, ones, heads = (sum((g[k] for g in grams), Counter()) for k in range(3))
    total, out = sum(ones.values()), []
    for w, (own2, own1, own_h) in zip(words, grams, strict=True):
        logs = []
        for h, x in zip(w, w[1:], strict=False):
            n = pairs[h, x] - own2[h, x]
            logs.append(math.log(n / (heads[h] - own_h[h])) if n else math.log(0.4 * max(ones[x] - own1[x], 1) / total))
        out.append((len(logs), sum(logs) / len(logs) if logs else None))
    return out


@pytest.mark.parametrize(("block", "part"), [(1, 50), (400, 7), (5000, 1), (1 << 22, 10**6)])
def test_op4_blocks(spark, block, part):
    rng = random.Random(block)
    texts = [None, "", " ", "a", "\u00e9 a\t\u00e9 a", *(" ".join(rng.choice(["a", "b", "hot", "é", "w" * 70, str(rng.randrange(40))]) for _ in range(rng.randrange(40))) for _ in range(60)), "hot hot " * 300]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    found = {r["doc_id"]: r for r in lm.backoff_scores(frame, block=block, part=part).collect()}
    assert len(found) == len(texts)
    for k, (n, score) in enumerate(brute_backoff(texts)):
        assert found[k]["n_pairs"] == n and found[k]["score"] == (None if score is None else pytest.approx(score, abs=1e-9))


@pytest.mark.parametrize("chunk", [1, 64, 1 << 20])
def test_op4_hashes(monkeypatch, chunk):
    monkeypatch.setattr(lm, "CHUNK", chunk)
    texts = ["a b  c\td", None, "", " x ", "é a b\n", "\u00a0a \x1fa", "long" * 900 + " z " + "y" * 3, *(f"w{i} {i}w" for i in range(2000))]
    words = [(i, w) for i, t in enumerate(texts) for w in (t or "").encode().split()]
    for start in (0, 3):
        hashes, doc = lm.hash_words(pa.array(texts).slice(start))
        want = [(i - start, w) for i, w in words if i >= start]
        assert doc.tolist() == [i for i, _ in want]
        assert len(set(zip(hashes.tolist(), (w for _, w in want), strict=True))) == len(set(hashes.tolist())) == len({w for _, w in want})
    n = np.array([0, 1, 255, 256, 1 << 40], np.int64)
    assert lm.unpack([lm.pack(n), lm.pack(n[:0])])[0].tolist() == n.tolist()


# 5 packing


def check_packing(frame, rows, window, **options):
    ids = {}
    pieces = packing.pack_windows(frame, public_tokenizers.path("word_bpe_49k.json"), window=window, **options).collect()
    vocabulary = tokens.ids_of(public_tokenizers.path("word_bpe_49k.json"))
    want = sorted(np.frombuffer(vocabulary.whole(t or ""), "<u4").tolist() + [2] for _, t in rows)
    sequences = {}
    for p in pieces:
        sequences.setdefault(p["sequence_id"], []).append(p)
        ids.setdefault(p["doc_id"], []).append(p)
    for seq in sequences.values():
        at = 0
        for p in sorted(seq, key=lambda p: p["offset"]):
            assert p["offset"] == at and p["length"] > 0
            at += p["length"]
        assert at <= window
    assert sum(p["length"] for p in pieces) == sum(map(len, want))
    if len({i for i, _ in rows}) == len(rows):
        got = [np.concatenate([np.frombuffer(bytes(p["ids"]), "<u4") for p in sorted(ps, key=lambda p: p["start"])]).tolist() for ps in ids.values()]
        assert sorted(got) == want and all(p["doc_tokens"] == sum(q["length"] for q in ids[p["doc_id"]]) for p in pieces)
    return sequences


def test_op5(spark, docs, odd, empty):
    frame, rows = spark.read.parquet(f"{SF}/documents.parquet"), [(i, r["text"]) for i, r in docs.items()]
    sequences = check_packing(frame, rows, 4096)
    assert sum(sum(p["length"] for p in s) < 4096 for s in sequences.values()) <= 1
    check_packing(frame, rows, 100, shard_tokens=20_000)
    check_packing(odd, [(r[0], r[1]) for r in ODD], 64)
    check_packing(empty, [], 64)


def test_op5_neighbours_come_first():
    docs = [np.array(x) for x in ([1, 2, 3, 4], [9, 9, 8, 8], [1, 2, 3, 5], [9, 8, 7, 7])]
    pieces = packing.fill_windows(docs, np.ones(10, np.float32), 4.0, 8)
    assert [[p[0] for p in pieces if p[3] == w] for w in (0, 1)] == [[0, 2], [1, 3]]
    index = packing.Index(docs, np.ones(10, np.float32), 4.0)
    weight = lambda tf: tf * (packing.K1 + 1) / (tf + packing.K1)
    assert index.scores(0) == pytest.approx([4 * weight(1), 0, 3 * weight(1), 0]) and index.scores(1)[3] == pytest.approx(2 * weight(1))


def test_op5_greedy_against_brute_force():
    rng = np.random.default_rng(5)
    docs = [np.minimum(rng.geometric(0.02, rng.integers(1, 60)), 299).astype("<u2") for _ in range(150)]
    df = Counter(int(t) for d in docs for t in set(d.tolist()))
    idf = np.array([math.log1p((len(docs) - df[t] + 0.5) / (df[t] + 0.5)) for t in range(300)], np.float32)
    mean = sum(map(len, docs)) / len(docs)
    tf = [Counter(d.tolist()) for d in docs]

    def score(seed, d):
        norm = packing.K1 * (1 - packing.B + packing.B * len(docs[d]) / mean)
        return sum(idf[t] * tf[d][t] * (packing.K1 + 1) / (tf[d][t] + norm) for t in tf[seed] if t in tf[d])

    index = packing.Index(docs, idf, mean)
    assert len(index.dense) and all(index.scores(s) == pytest.approx([score(s, d) for d in range(150)], rel=1e-4, abs=1e-4) for s in (0, 9, 77))
    pieces, used, seed, last = packing.fill_windows(docs, idf, mean, 100), set(), None, None
    assert sorted((d, s + k) for d, s, n, _, _ in pieces for k in range(n)) == [(d, k) for d in range(150) for k in range(len(docs[d]))]
    for d, start, _, number, _ in pieces:
        if number != last or seed is None:
            seed, last = d, number  # what begins a window seeds it
        elif not start and d not in used:
            best = max(score(seed, x) for x in range(150) if x not in used)
            assert score(seed, d) >= best - 1e-3 or best == 0
            if score(seed, d) == 0:
                seed = d  # nothing shares an id: the first unused document seeds anew
        used.add(d)


def test_op5_shards_hold_alike(spark):
    rng = random.Random(3)
    words = [["".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=7)) for _ in range(40)] for _ in range(16)]
    rows = [(i, " ".join(rng.choices(words[i % 16], k=60))) for i in range(640)]
    rows += [(i + 640, rows[i][1]) for i in range(640)] + [(i, "same " * 100) for i in range(1280, 1480)]
    pieces = packing.pack_windows(spark.createDataFrame(rows, "doc_id long, text string").repartition(7), public_tokenizers.path("word_bpe_49k.json"), window=512, shard_tokens=20_000).collect()
    shard = {p["doc_id"]: p["sequence_id"] >> 32 for p in pieces}
    tokens = Counter()
    for p in pieces:
        tokens[p["sequence_id"] >> 32] += p["length"]
    assert len(tokens) > 8 and max(tokens.values()) < 50_000
    assert all(shard[i] == shard[i + 640] for i in range(640))
    together = sum(shard[a] == shard[b] for t in range(16) for a in range(t, 640, 16) for b in range(t, a, 16))
    assert together > 0.5 * 16 * 40 * 39 / 2


# 6 quality


def brute_signals(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    grams = [tuple(words[i: i + 3]) for i in range(len(words) - 2)]
    cover = {i + k for i, g in enumerate(grams) if grams.count(g) > 1 for k in range(3)}
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(cover))


def test_op6_counts(docs):
    texts = [r["text"] for r in docs.values() if len(r["text"] or "") < 4000] + [None, "", "a", "a b c", "a a a a", "x\nx\n \nx", "   b"]
    assert all(quality.count_signals(t)[:5] == brute_signals(t) for t in texts)


def test_op6_bound():
    assert quality.binomial_tail(0, 10, 0.1) == pytest.approx(0.9**10) and quality.binomial_tail(10, 10, 0.5) == pytest.approx(1)
    assert quality.binomial_tail(3, 20, 0.2) == pytest.approx(sum(math.comb(20, i) * 0.2**i * 0.8 ** (20 - i) for i in range(4)))
    none = {r: [0] * len(c) for r, c in quality.RULES.items()}
    assert all(v is None for v in quality.pick_cutoffs(none, 20, 1, 0.05, 0.05).values())
    assert quality.pick_cutoffs(none, 5000, 1, 0.05, 0.05) == {r: c[-1] for r, c in quality.RULES.items()}
    some = none | {"symbols_per_word": [0, 0, 0, 400, 400, 400, 400, 400, 400, 400]}
    assert quality.pick_cutoffs(some, 5000, 1, 0.05, 0.05)["symbols_per_word"] == 1.5


def test_op6_rules_reject_junk_and_keep_good(spark):
    rng = random.Random(4)
    text = lambda: " ".join("".join(rng.choices("abcdefgh", k=rng.randrange(2, 9))) for _ in range(80))
    rows = [(i, text() if i % 3 else text().replace(" ", "### "), "en", "s", 1) for i in range(1800)]
    labels = spark.createDataFrame([(i, int(i % 3 > 0), 0) for i in range(1800)] + [(None, 1, 0), (5, None, 0), (99999, 1, 1)], "doc_id long, quality int, toxic int")
    got = {r["doc_id"]: r["kept"] for r in quality.quality_verdicts(spark.createDataFrame(rows, DOCS), labels).collect()}
    assert not any(got[i] for i in range(0, 1800, 3)) and sum(got[i] for i in got if i % 3) >= 0.95 * 1200


def test_op6_small_strata_have_rules(spark):
    rng = random.Random(6)
    text = lambda: " ".join("".join(rng.choices("abcdefgh", k=rng.randrange(2, 9))) for _ in range(80))
    rows = [(i, text() if i % 4 else text().replace(" ", "### "), ("en", "de", "fr", "es")[i // 400], "s", 1) for i in range(1600)]
    labels = spark.createDataFrame([(i, int(i % 4 > 0), 0) for i in range(1600)], "doc_id long, quality int, toxic int")
    got = {r["doc_id"]: r["kept"] for r in quality.quality_verdicts(spark.createDataFrame(rows, DOCS), labels).collect()}
    assert not any(got[i] for i in range(0, 1600, 4)) and sum(got[i] for i in got if i % 4) >= 0.95 * 1200
    joint = {"any": [0, 0, 1, 20] + [20] * 6}
    assert quality.pick_cutoffs(joint, 300, 4, 0.05, 0.05) == {r: c[2] for r, c in quality.RULES.items()}
    assert quality.pick_cutoffs({"any": [0] * 10}, 86, 4, 0.05, 0.05)["symbols_per_word"] == 0.1
    assert quality.pick_cutoffs({"any": [0] * 10}, 85, 4, 0.05, 0.05)["symbols_per_word"] is None


def test_op6_kept_against_brute_force(spark):
    """Cutoffs and verdicts recomputed row by row, over a table where one stratum has rules and others have none."""
    sf = "/root/testdata/sf0.01"
    rows, labels = spark.read.parquet(f"{sf}/documents.parquet").collect(), {}
    for r in spark.read.parquet(f"{sf}/labels.parquet").collect():
        if r["doc_id"] is not None and r["quality"] is not None:
            labels[r["doc_id"]] = min(r["quality"], labels.get(r["doc_id"], 1))
    names = [*quality.BASE, *quality.EXTRA]

    def ratios(text):
        c = dict(zip(names, quality.count_signals(text), strict=True))
        words, chars, lines = max(c["n_words"], 1), max(c["word_chars"], 1), max(c["n_lines"], 1)
        base = c["n_words"] < 50 or 100 * c["n_repeat_words"] > 50 * c["n_words"]
        return base, [c["n_symbols"] / words, c["n_bangs"] / words, c["n_capitals"] / chars, c["n_dup_lines"] / lines, c["n_repeat_words"] / words, c["word_chars"] / words]

    found = {id(r): ratios(r["text"]) for r in rows}
    held = {}
    for r in rows:
        if labels.get(r["doc_id"]) == 1 and not found[id(r)][0]:
            held.setdefault(r["lang"], {})[r["text"]] = found[id(r)][1]
    cuts = [[c[min(k, len(c) - 1)] for c in quality.RULES.values()] for k in range(quality.LEVELS)]
    chosen = {}
    for lang, texts in held.items():
        for cut in cuts:
            n, k = len(texts), sum(any(v > c for v, c in zip(x, cut, strict=True)) for x in texts.values())
            tail = sum(math.comb(n, i) * 0.05**i * 0.95 ** (n - i) for i in range(k + 1))
            if k > 0.05 * n or tail > 0.05 / len(held):
                break
            chosen[lang] = cut
    assert 0 < len(chosen) < len(held)
    want = Counter((r["doc_id"], not found[id(r)][0] and not any(v > c for v, c in zip(found[id(r)][1], chosen.get(r["lang"], [math.inf] * 6), strict=True))) for r in rows)
    assert Counter((r["doc_id"], r["kept"]) for r in queries.op6_quality(spark, sf).collect()) == want


def test_op6_guarantee_in_simulation():
    """Holdouts drawn with known rates: a cutoff whose true rate is above alpha is hardly ever chosen in any of four strata."""
    rng, rates, bad = np.random.default_rng(4), np.linspace(0.005, 0.09, quality.LEVELS), 0
    cutoffs = quality.RULES["symbols_per_word"]
    for _ in range(1500):
        wrong = False
        for _ in range(4):
            draws = rng.random(400)
            counts = {"any": [int((draws < r).sum()) for r in rates]}
            got = quality.pick_cutoffs(counts, 400, 4, 0.05, 0.05)["symbols_per_word"]
            wrong |= got is not None and rates[cutoffs.index(got)] > 0.05
        bad += wrong
    assert bad / 1500 <= 0.05 + 3 * math.sqrt(0.05 * 0.95 / 1500)


def test_op6_copies_are_one_trial(spark):
    text = lambda i: " ".join(f"w{i}x{k}" for k in range(60))
    frame = lambda n: spark.createDataFrame([(i, text(i % n), "en", "s", 1) for i in range(200)], DOCS)
    labels = spark.createDataFrame([(i, 1) for i in range(200)], "doc_id long, quality int")
    picked = lambda n: quality.learn_cutoffs(quality.add_signals(frame(n).withColumn(quality.TEXT, F.xxhash64("text"))), labels).first()["chars_per_word"]
    assert picked(200) is not None and picked(20) is None


def test_op6_edges(spark, odd, empty):
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    rows = quality.quality_verdicts(odd, labels).collect()
    assert len(rows) == len(ODD) and all(r["base_failed"] and not r["kept"] for r in rows)
    assert quality.keep_quality(odd, labels).count() == 0 and quality.quality_verdicts(empty, labels).count() == 0
    good = spark.createDataFrame([(1, " ".join(map(str, range(60))), None, None, None)] * 2, DOCS)
    assert quality.keep_quality(good, labels).count() == 2


# 7 html


@pytest.mark.parametrize(("page", "text"), [
    (None, ""), ("", ""), ("plain &amp; simple", "plain & simple"), ("a < b", "a < b"), ("<p>one<p>two", "one two"), ("<p>a<b>b</b>c<br>d</p>", "abc d"),
    ("<header>H</header><nav>N</nav><article><h1>T</h1><p>x &lt; y&nbsp;z</p><aside>no</aside><form>no</form></article><footer>F</footer>", "T x < y z"),
    ("<article><p>t</p><div id='comments'>no</div></article><div class='cookie-notice'>no</div>", "t"), ("<article>t<section class=commentList><p>no</p></section>", "t"),
    ("<div class=menu>m</div><div><p>one</div>two<script>if (a<b) '</p>'</script>", "one two"), ("<article><p>cut &am", "cut &am"), ("<article>a <span class='ad'>no</span> b</article>", "a b"), ("<!-- <p>no</p> --><p>y", "y"),
    ("<article><p title=it's>Text don't stop</p><p>more</p></article>", "Text don't stop more"), ("<article>a <math><mi>x</mi></math> <svg><text>s</text></svg> <noscript>n</noscript></article>", "a x s n"), ("<article><p class='share price'>up</p><section id='related'>s</section><p class='ad'>no</p></article>", "up s"),
    ("<p a='>' b=\"'>\" c=\"x>y>z\" d=e'f\">t</p>", "t"), ("<div id=c><h1>T</h1><div>the body of the text</div></div><div>x</div>", "T the body of the text"), ("<main><div>the long story that this page is about</div><article class=card>teaser</article></main>", "the long story that this page is about"),
    ("<main>m<article>a</article></main>", "a"), ("<main>m</main><div>d</div>", "m"), ("<article><header><h1>T</h1></header>x</article>", "T x"),
])
def test_op7_pages(page, text):
    assert html.main_text(page, set(), set()) == text


def brute_classes(pages):
    """Valid classes of a host's pages as sets of (path, text), text None for elements."""
    times = []
    for page in pages:
        elements, blocks = html.parse(page)
        times.append(Counter([(e[0], None) for e in elements] + [(elements[e][0], text) for e, text, _ in blocks]))
    found = {}
    for token in set().union(*times):
        vector = tuple(t[token] for t in times)
        if sum(n > 0 for n in vector) >= max(2, html.SUPPORT * len(pages)):
            found.setdefault(vector, set()).add(token)
    return [c for c in found.values() if any(text is None for _, text in c)]


def shell(i, body):
    """A page without names to go by: a fixed block longer than any article, links, and the article in a division."""
    return f"<html><body><div class=x1><p>{'House words on every page. ' * 30}</p></div><div class=x2><div>{'<p>entry</p>' * 3}</div></div><div class=x3>{body}</div><div class=x4><p>All rights {i % 3}</p></div></body></html>"


def body(i):
    return f"<h1>Head {i}</h1><p>Article number {i} has text of its own, long enough to count.</p>" + f"<p>More {i}</p>" * (i % 3)


def test_op7_classes_against_brute_force(spark):
    htmls = [shell(i, body(i)) for i in range(9)] + ["<html><body><main><p>other layout one</p></main></body></html>", "<html><body><main><p>other layout two</p></main></body></html>"]
    frame = spark.createDataFrame([(i, f"http://h.example/{i}", h) for i, h in enumerate(htmls)], "page_id long, url string, html string")
    token = lambda path, text: html._hash(path) if text is None else html._hash(path, text)
    want = [{token(*t) for t in c} for c in brute_classes(htmls)]
    got = html.deduce_templates(frame).collect()
    assert sorted(sorted([*r["elements"], *r["texts"]]) for r in got) == sorted(map(sorted, want)) and len(want) >= 4
    held = {r["class"]: r for r in got}
    for r in got:  # a class nests in that of the element around its outermost one
        assert (r["parent"] is None) == (r["path"] == "") and (r["path"] == "" or html._hash(r["path"].rsplit("/", 1)[0]) in held[r["parent"]]["elements"] or r["path"].count("/") < 2)


def test_op7_template(spark):
    rows = [(i, f"http://h.example/{i}", shell(i, body(i))) for i in range(12)] + [(50 + i, f"http://two.example/{i}", shell(i, body(i))) for i in range(2)]
    rows += [(60 + i, f"http://both.example/{i}", shell(i, body(i)) if i % 2 else f"<html><body><section class=s><p>Story {i} in another layout.</p></section><div><p>{'Fixed words of it. ' * 20}</p></div></body></html>") for i in range(8)]
    rows += [(90, None, None), (91, "odd", "<p>x"), (91, "odd", "<p>x"), (92, "http://lone.example/", shell(0, body(0)))]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = {r["page_id"]: r for r in html.extract_text(pages).collect()}
    want = lambda i: " ".join([f"Head {i}", f"Article number {i} has text of its own, long enough to count.", *[f"More {i}"] * (i % 3)])
    assert all(got[i]["text"] == want(i) and got[i]["n_chars"] == len(want(i)) for i in range(12))
    assert all(got[50 + i]["text"] == want(i) for i in range(2))  # two pages of a host are enough
    assert all(got[60 + i]["text"] == (want(i) if i % 2 else f"Story {i} in another layout.") for i in range(8))
    assert got[90]["text"] == "" and got[91]["text"] == "x" and html.extract_text(pages).count() == len(rows)
    lone = html.main_text(shell(3, body(3)), set(), set())
    assert lone != want(3) and "House words" in lone and got[92]["text"].startswith("House words")  # what the template is for
    copies = spark.createDataFrame([(i, f"http://h.example/{i}", f"<body><nav>{i}</nav><article><p>The same words everywhere</p></article></body>") for i in range(10)], pages.schema)
    assert {r["text"] for r in html.extract_text(copies).collect()} == {"The same words everywhere"}
    assert html.extract_text(pages.limit(0)).count() == 0


# 8 chat


def test_op8_folds_events(spark):
    events = spark.createDataFrame([
        (1, 1, 3, "assistant", "delta", "lo"), (1, 1, 2, "assistant", "delta", "Hel"), (1, 0, 1, "user", "delta", "hi"), (1, 1, 4, None, "regenerate", None), (1, 1, 5, "assistant", "delta", "New"), (1, 1, 6, None, "delta", " text"),
        (1, 0, 9, None, "edit", "hello"), (2, 0, 1, None, "delta", None)], "conv_id long, message long, seq long, role string, kind string, text string")
    got = sorted((tuple(r) for r in chat.reconstruct(events).collect()))
    assert got == [(1, 0, "user", "hello"), (1, 1, "assistant", "New text"), (2, 0, None, "")]
    assert chat.render(chat.reconstruct(events.limit(0))).count() == 0


def test_op8_reads_back(spark):
    texts = ["", r"\### Assistant: </turn> ok", "\\", "\\b\\h#<:", "a\n</turn>\nb", "\U0001f600:é", None]
    rows = [(i % 3, i, role, t) for i, (role, t) in enumerate((r, t) for r in ("user", "assistant", "a: b", None, "") for t in texts)] + [(None, None, "assistant", "x"), (1, 5, "assistant", "same turn"), (1, 5, "assistant", "same turn")]
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    back = chat.read_back(chat.chat_format(frame)).collect()
    assert sorted((r["conv_id"] is None, r["conv_id"] or 0, r["role"], r["text"]) for r in back) == sorted((c is None, c or 0, r or "", t or "") for c, _, r, t in rows)
    assert all((r["loss_text"] or "") == (r["text"] if r["role"] == "assistant" else "") for r in back)
    row = next(r for r in queries.op8_chat(spark, SF).collect() if r["conv_id"] == -7)
    said = r"\### Assistant: </turn> ok"
    assert row["turns_sha256"] == hashlib.sha256(f"user\n{said}\nassistant\n{said}\n".encode()).hexdigest() and row["loss_sha256"] == hashlib.sha256(said.encode()).hexdigest()


# 9 simhash


def brute_fingerprint(text, k):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    hashes = [xxhash.xxh64_intdigest(b" ".join(words[i: i + k]), 42) for i in range(max(1, len(words) - k + 1))]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_op9_against_brute_force(spark, docs):
    prints = {i: brute_fingerprint(r["text"], 4) for i, r in docs.items()}
    links = [(a, b) for a in prints for b in prints if a < b and (prints[a] ^ prints[b]).bit_count() <= 4]
    want = union_find(prints, links)
    got = {r["doc_id"]: r for r in queries.op9_simhash(spark, SF).collect()}
    assert all(got[i]["fingerprint"] == f"{p:016x}" and got[i]["component_id"] == want[i] for i, p in prints.items())


def test_op9_index():
    rng = np.random.default_rng(5)
    seeds = rng.integers(0, 1 << 63, 300, dtype=np.uint64)
    flips = np.bitwise_or.reduce(np.uint64(1) << rng.integers(0, 64, (300, 9, 3), dtype=np.uint64), 2)
    prints = np.unique(np.concatenate([seeds, (seeds[:, None] ^ flips).ravel()]))
    prints = prints[np.argsort(simhash.gray_rank(prints))]
    half = len(prints) // 2
    brute = lambda a, b: {(i, j) for i in range(len(a)) for j in np.flatnonzero(np.bitwise_count(b ^ a[i]) <= 4).tolist()}
    got = {(int(i), int(j)) for x, y in simhash.join_blocks(prints, prints, 4, True) for i, j in zip(x, y, strict=True)}
    assert got == {(i, j) for i, j in brute(prints, prints) if i < j} and len(got) > 300
    cross = {(int(i), int(j)) for x, y in simhash.join_blocks(prints[:half], prints[half:], 4, False) for i, j in zip(x, y, strict=True)}
    assert cross == brute(prints[:half], prints[half:])


def test_op9_blocks_that_cannot_meet():
    prints = np.random.default_rng(6).integers(0, 1 << 63, 4000, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    rank = simhash.gray_rank(prints) >> np.uint64(1)
    pivots = np.sort(rank)[np.arange(1, 400) * 10]
    mask, pattern = simhash.block_bits(pivots)
    block = np.searchsorted(pivots, rank, side="left")
    assert ((prints & mask[block]) == pattern[block]).all() and np.bitwise_count(mask).mean() > 6  # a block across a high power of two shares few bits
    apart = np.bitwise_count((pattern[:, None] ^ pattern) & mask[:, None] & mask)
    assert (apart > 4).mean() > 0.1 and not (apart.diagonal()).any()


def test_op9_forest_of_doubtful_links():
    rng = np.random.default_rng(7)
    base = rng.integers(0, 1 << 63, (12, 8), dtype=np.uint64)
    rows = np.repeat(base, 20, 0)
    for k in range(len(rows)):
        for bit in rng.choice(512, rng.integers(0, 30), replace=False):
            rows[k, bit // 64] ^= np.uint64(1) << np.uint64(bit % 64)
    n = len(rows)
    full = np.column_stack([rows, np.arange(n, dtype=np.uint64)])
    full = full[np.argsort(simhash.gray_rank(full[:, 0]), kind="stable")]
    u, v, sure = simhash.links_forest(full, full, 18, (20, 40), True)
    apart = np.bitwise_count(rows[:, None] ^ rows).sum(2)
    near = (np.bitwise_count(rows[:, None, 0] ^ rows[:, 0]) <= 18) & (apart <= 40)
    links = [(i, j) for i in range(n) for j in range(i) if near[i, j]]
    want = union_find(range(n), [(i, j) for i, j in links if apart[i, j] <= 20])
    assert union_find(range(n), [(a, b) for a, b, s in zip(u.tolist(), v.tolist(), sure.tolist(), strict=True) if s]) == want
    assert union_find(range(n), zip(u.tolist(), v.tolist(), strict=True)) == union_find(range(n), links) and len(u) < n
    assert all(20 < apart[a, b] <= 40 for a, b, s in zip(u.tolist(), v.tolist(), sure.tolist(), strict=True) if not s)


def test_op9_edges(odd, empty):
    rows = [(r["doc_id"], r["fp"], r["component_id"]) for r in simhash.near_duplicates(odd.select("doc_id", "text")).collect()]
    assert len(rows) == len(ODD) and {c for _, fp, c in rows if fp == 0} == {1}
    assert simhash.near_duplicates(empty.select("doc_id", "text")).count() == 0
    kept = [r["doc_id"] for r in simhash.drop_near_duplicates(odd).collect()]
    assert sorted(k for k in kept if k is not None) == [1, 4, 5, 5, 6]
    assert None in kept and simhash.drop_near_duplicates(empty).count() == 0


def test_near_dedup_by_similarity(spark):
    rng = random.Random(6)
    word = lambda: "".join(rng.choices("abcdefghijklmnop", k=7))
    base = [[word() for _ in range(400)] for _ in range(30)]
    rows = [(i, " ".join(b), "en", "s", 1) for i, b in enumerate(base)]
    for i, b in enumerate(base[:10]):
        rows.append((100 + i, " ".join([word(), *b[1:200], word(), *b[201:]]), "en", "s", 1))
    kept = {r["doc_id"] for r in simhash.drop_near_duplicates(spark.createDataFrame(rows, DOCS)).collect()}
    assert kept == set(range(30))


def test_near_dedup_against_brute_force(spark, monkeypatch):
    """Texts with 0 to 15 words changed: one of each group by true similarity stays, also where groups are cut into parts."""
    groups = 60
    rng = random.Random(8)
    word = lambda: "".join(rng.choices("abcdefghijklmnop", k=7))
    texts = []
    for _ in range(groups):
        base = [word() for _ in range(300)]
        for _ in range(4):
            copy = list(base)
            for k in rng.sample(range(300), rng.randint(0, 15)):
                copy[k] = word()
            texts.append(copy)
    shingles = [{tuple(t[i: i + 5]) for i in range(296)} for t in texts]
    links = [(i, j) for i in range(len(texts)) for j in range(i // 4 * 4, i) if len(shingles[i] & shingles[j]) >= 0.8 * len(shingles[i] | shingles[j])]
    want = set(union_find(range(len(texts)), links).values())
    rows = [(i, " ".join(t), "en", "s", 1) for i, t in enumerate(texts)]
    frame = spark.createDataFrame(rows, DOCS)
    assert {r["doc_id"] for r in simhash.drop_near_duplicates(frame).collect()} == want and len(want) > groups + 10
    whole = simhash.confirm
    monkeypatch.setattr(simhash, "confirm", lambda *a: whole(*a, size=2))
    assert {r["doc_id"] for r in simhash.drop_near_duplicates(frame).collect()} == want


# 10 mixing


def test_op10_targets(spark):
    sizes = {None: 100, "": 10, "a": 1, "b": 1000, "c": 0}
    got = {r["source"]: r["target"] for r in mixing.source_targets(spark.createDataFrame(list(sizes.items()), "source string, size long")).collect()}
    weights, capped, total = {"": 1, "a": 2, "b": 3, "c": 1, None: 2}, {}, sum(sizes.values())
    while True:
        rest, weight = total - sum(capped.values()), sum(w for s, w in weights.items() if s not in capped)
        over = {s: 3.0 * sizes[s] for s, w in weights.items() if s not in capped and w * rest / weight >= 3 * sizes[s]}
        if not over:
            break
        capped |= over
    assert got == pytest.approx({s: capped.get(s, w * rest / weight) for s, w in weights.items()}) and sum(got.values()) == pytest.approx(total)


def test_op10_takes_near_target(spark):
    rng = random.Random(7)
    rows = [(i, " ".join(["w"] * rng.randrange(1, 200)), "en", rng.choice(["x", "y", "z", None]) if i % 3 else "x", 1) for i in range(3000)]
    mixed = mixing.mix_documents(spark.createDataFrame(rows, DOCS))
    assert mixed.where("copies < 0 OR copies > 3").count() == 0
    for r in mixed.groupBy("source").agg(F.sum(F.col("copies") * F.col("size")).alias("taken"), F.first("target").alias("target")).collect():
        assert abs(r["taken"] - r["target"]) < 0.02 * r["target"] + 400


def test_op10_edges(odd, empty):
    rows = mixing.mix_documents(odd).collect()
    assert len(rows) == len(ODD) and all(r["copies"] == 0 for r in rows if r["source"] == "")
    assert [sorted(map(str, mixing.mix_documents(odd).collect())) == sorted(map(str, rows))] == [True]
    assert mixing.mix_documents(empty).count() == 0


# Columns with the names that operators use


CLASH = ["size", "source_size", "target", "copies", "fp", "wide", "component_id", "group", "shard", "slot", "grown_shard", "n_words", "kept", "base_failed", "n_links", "row", "ids", "text_crc32", "_key", "_row", "_node", "rank", "copy", "doc", "col"]


def test_clashing_columns_of_files_and_chats(spark, odd, tmp_path):
    wide = odd.select("*", *[F.lit(i).alias(c) for i, c in enumerate(("part", "segment", "n_tokens", "doc_ids", "payload", "start", "ids", "first"))])
    rangecoder.write_token_files(wide, public_tokenizers.path("byte_bpe_50k.json"), str(tmp_path / "f"))
    assert rangecoder.read_token_files(spark.read.parquet(str(tmp_path / "f"))).count() == len(ODD)
    rows = spark.createDataFrame([(1, 0, "user", "hi", 1, 2, 3), (1, 1, "assistant", "yo", 4, 5, 6)], "conv_id long, turn long, role string, text string, seq int, message int, ord int")
    assert [r["text"] for r in chat.read_back(chat.chat_format(rows)).orderBy("ord").collect()] == ["hi", "yo"]


def test_clashing_columns(spark, odd):
    wide = odd.select("*", *[F.lit(i).alias(c) for i, c in enumerate(CLASH)])
    labels = spark.createDataFrame([(1, 1, 0, 5)], "doc_id long, quality int, toxic int, lang int")
    n = len(ODD)
    assert simhash.near_duplicates(wide).count() == mixing.mix_documents(wide).count() == quality.quality_verdicts(wide, labels).count() == lm.backoff_scores(wide).count() == n
    assert sharding.number_slots(sharding.assign_shards(wide, sharding.shard_tree(8))).count() == n
    assert packing.pack_windows(wide, public_tokenizers.path("word_bpe_49k.json")).count() >= n
    kept = simhash.drop_near_duplicates(wide)
    assert kept.columns == wide.columns and {tuple(r[c] for c in CLASH) for r in kept.collect()} == {tuple(range(len(CLASH)))}
    assert quality.keep_quality(wide, labels).columns == wide.columns
    pages = spark.createDataFrame([(1, "http://h/1", "<p>x", 1, 2, 3)], "page_id long, url string, html string, text int, n_chars int, host int")
    assert html.extract_text(pages).first()["text"] == "x"
    vecs = spark.createDataFrame([(1, [1.0], 2, 3, 4)], "vec_id long, embedding array<float>, n_links int, component_id int, node int")
    assert embeddings.near_duplicates(vecs).first()["n_links"] == 0

"""Phrase collocations against brute force."""

import re
from collections import Counter

import numpy as np
import pytest

from orolith.llm import phrases


def brute(rows, min_count, longest, share=50, top=2000):
    """rows: (lang, text)."""
    out = []
    for lang in {r[0] or "und" for r in rows}:
        counts: Counter = Counter()
        for text in (t for g, t in rows if (g or "und") == lang and t):
            lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)
            for piece in re.split(r"[.,;:!?\x0A-\x0D]", lowered):
                ws = [w for w in re.split(r"[\x20\x09]+", piece) if w]
                for n in range(1, longest + 1):
                    counts.update(tuple(ws[i: i + n]) for i in range(len(ws) - n + 1))
        total = sum(c for p, c in counts.items() if len(p) == 1)
        good = {p: c for p, c in counts.items() if c >= min_count and len(p) > 1}
        scored = []
        for p, a in good.items():
            score, _, k = min((1000000 * a * a // (counts[p[:k]] * counts[p[k:]]), k, k) for k in range(1, len(p)))
            inside = [c for q, c in good.items() if len(q) > len(p) and any(q[i: i + len(p)] == p for i in range(len(q) - len(p) + 1))]
            if not any(100 * c >= share * a for c in inside):
                scored.append((-score, -a, " ".join(p).encode(), counts[p[:k]], counts[p[k:]]))
        out += [(lang, r, p.decode(), -a, left, right, total, -s) for r, (s, a, p, left, right) in enumerate(sorted(scored)[:top], 1)]
    return sorted(out)


def run(spark, rows, **options):
    docs = spark.createDataFrame(rows, "lang string, text string, rank string, n string")
    return sorted(tuple(r) for r in phrases.collocations(docs, **options).collect())


@pytest.mark.parametrize("longest,width", [(2, 1 << 25), (3, 64), (3, 1 << 25), (4, 1 << 12)])
def test_against_brute_force(spark, monkeypatch, longest, width):
    """Also with sketches far too small, which let nearly all pass, and windows of a few pieces."""
    monkeypatch.setattr(phrases, "WINDOW", 200)
    monkeypatch.setattr(phrases, "HELD", 50)
    rng = np.random.default_rng(longest)
    words = ["the", "The", "new", "york", "état", "São", "x1", "a-b", "\x1c", "q\xa0q", "big", "of"]
    gaps = [" ", " ", " ", "  ", "\t", ". ", ",", "\n", "\r\n", "\x0b", "! "]
    text = lambda: "".join(rng.choice(words, p=rng.permutation(np.arange(1, 13)) / 78) + rng.choice(gaps) for _ in range(int(rng.integers(0, 60))))
    rows = [(rng.choice(["en", "fr", None, "und"]), text(), "x", None) for _ in range(300)]
    rows += [("en", None, None, None), ("de", "", None, None), rows[0], rows[0]]
    found = run(spark, rows, min_count=6, longest=longest, width=width)
    assert found == brute([r[:2] for r in rows], 6, longest) and len(found) > 50


def test_shares_ranks_and_edges(spark):
    rows = [("en", "red hot iron. " * 10 + "red hot " * 9, None, None), ("fr", "bon jour, " * 12 + "seul " * 3, None, None)]
    assert run(spark, rows) == brute([r[:2] for r in rows], 10, 3)
    assert run(spark, rows, top=1) == brute([r[:2] for r in rows], 10, 3, top=1)
    assert run(spark, []) == [] and run(spark, [(None, None, None, None)]) == [] and run(spark, [("en", "one two", None, None)]) == []


def test_a_long_text_and_large_counts(spark):
    rows = [("en", "of the " * 200_000, None, None)]
    assert run(spark, rows) == brute([r[:2] for r in rows], 10, 3)


def test_frequent_grams_always_pass(spark):
    docs = spark.createDataFrame([("en", f"w{i % 40} w{i % 7} v{i}") for i in range(3000)], "lang string, text string")
    found = {(r["k"], r["phrase"]): r["n"] for r in phrases.frequent_phrases(docs, width=256).collect()}
    assert {(1, f"w{k}") for k in range(40)} <= set(found)
    assert found[(0, "")] == 9000 and not any(p.startswith("v") for _, p in found)


def test_counted_phrases_come_in_order_with_their_own_counts():
    """Disk of op12_phrases: rows in the order of their hashes share no beginnings, so shuffles compressed less."""
    import numpy as np
    from orolith.llm import phrases

    held = phrases.Counted()
    first, second = {5: (b"b c", 2, 0), 9: (b"a b", 3, 1)}, {1: (b"c", 4, 0), 7: (b"a a", 1, 0), 9: (b"a b", 10, 1)}
    for part in (first, second):
        keys = np.array(sorted(part), np.uint64)
        n, lang = (np.array([part[k][i] for k in sorted(part)], kind) for i, kind in ((1, np.int64), (2, np.int32)))
        held.add(keys, n, lang, lambda new, part=part: [part[sorted(part)[k]][0] for k in new])
    (batch,) = held.batches(2, ["en", "de"])
    assert [tuple(r.values()) for r in batch.to_pylist()] == [("en", 2, "a a", 1), ("de", 2, "a b", 13), ("en", 2, "b c", 2), ("en", 2, "c", 4)]

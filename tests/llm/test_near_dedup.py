"""The near-dedup stage where lines repeat: only distinct shingles count, and every link is tested."""

import random

import pytest

from orolith.llm import simhash

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def kept(spark, texts):
    frame = spark.createDataFrame([(i, t, "en", "s", 1) for i, t in enumerate(texts, 1)], DOCS)
    return {r["doc_id"] for r in simhash.drop_near_duplicates(frame).collect()}


def brute(texts):
    sets = []
    for t in texts:
        ws = t.lower().split()
        sets.append({tuple(ws[i: i + 5]) for i in range(max(len(ws) - 4, 1))})
    root = list(range(len(texts)))

    def find(n):
        while root[n] != n:
            n = root[n]
        return n

    for i in range(len(texts)):
        for j in range(i):
            if len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j]):
                p, q = find(i), find(j)
                root[max(p, q)] = min(p, q)
    return {i + 1 for i in range(len(texts)) if find(i) == i}


@pytest.fixture(scope="module")
def words():
    rng = random.Random(3)
    return lambda n: [" ".join("".join(rng.choices("abcdefghijklmnop", k=7)) for _ in range(n))][0]


def test_repeated_lines_make_no_copies_and_hide_none(spark, words):
    line, text = words(7), words(400)
    texts = [f"{line} " * 30 + words(250), f"{line} " * 30 + words(250), text, text + f" {line}" * 20]
    assert kept(spark, texts) == brute(texts) == {1, 2, 3}


def test_many_texts_with_repeated_lines(spark, words):
    rng = random.Random(5)
    lines = [words(7) for _ in range(4)]
    texts = []
    for _ in range(40):
        base = words(300).split()
        for _ in range(3):
            copy = list(base)
            for k in rng.sample(range(300), rng.randint(0, 14)):
                copy[k] = words(1)
            texts.append(" ".join(copy) + f" {rng.choice(lines)}" * rng.choice([0, 1, 10, 60]))
    texts += texts[:3] + ["", " "]
    assert kept(spark, texts) == brute(texts)


def test_rows_with_one_id_and_text_stay_the_same_in_reruns(spark, words):
    text = words(60)
    rows = [(1, text, "en", f"s{k}", k) for k in range(20)]
    runs = {tuple(simhash.drop_near_duplicates(spark.createDataFrame(rng, DOCS).repartition(n)).collect()) for n, rng in ((1, rows), (3, rows[::-1]), (5, rows))}
    assert len(runs) == 1

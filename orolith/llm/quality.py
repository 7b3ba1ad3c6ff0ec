"""Quality rules with risk-controlled thresholds.

A rule rejects a text whose signal exceeds a cutoff. For each stratum (language), a fixed
sequence of levels is tried from the loosest to the tightest on the labelled holdout; a
level tightens the cutoffs of all rules together. A level is good if so few good holdout
texts exceed any of its cutoffs that a true false-rejection rate above alpha has at most
the stratum's share of the error (an exact binomial tail, which is the Clopper-Pearson
bound); the first level that isn't ends the search. Tests in a fixed order need no
correction among themselves; over strata the error is divided (Bonferroni). So with
probability 1 - delta, in every stratum at most alpha of good texts are rejected by the
rules. At four strata 86 good labels without an exceedance pass a level. A stratum
without a good level has no rules.

Nothing is fitted to the labels but the choice among fixed cutoffs, so all labels serve
as holdout. All counts cover all labelled texts. Equal texts of a stratum are one trial, as
they are judged alike; near copies count as trials of their own. The guarantee is about texts that pass the base rules, which
reject good texts besides.

Defined results: a null text has no words and fails the base rules; a null language is a
stratum of its own; a document with any label of low quality isn't good; labels of no
document and null labels count for nothing; repeated rows are judged each; empty tables
give no rows; other columns pass through.
"""

from __future__ import annotations

import math
import operator
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialize

#: Cutoffs of each rule, from the loosest to the tightest; a text is rejected above the cutoff.
RULES = {
    "symbols_per_word": (3.0, 2.0, 1.5, 1.0, 0.7, 0.5, 0.3, 0.2, 0.15, 0.1),
    "bangs_per_word": (3.0, 2.0, 1.5, 1.0, 0.7, 0.5, 0.3, 0.2, 0.15, 0.1),
    "capitals_per_char": (0.95, 0.9, 0.8, 0.7, 0.6, 0.5, 0.4, 0.3),
    "dup_line_share": (0.95, 0.9, 0.8, 0.7, 0.6, 0.5, 0.4, 0.3, 0.2),
    "repeat_word_share": (0.48, 0.45, 0.4, 0.35, 0.3, 0.25, 0.2),
    "chars_per_word": (40.0, 30.0, 20.0, 16.0, 14.0, 12.0, 10.0),
}
LEVELS = max(map(len, RULES.values()))
BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
EXTRA = ("n_lines", "n_bangs", "n_capitals")
SYMBOLS, SPACE = "#*$%&|<>", " \t\n\v\f\r"


#: Column with a 64-bit hash of the text, by which equal texts are told.
TEXT = "_text"


def count_signals(text: str | None) -> tuple[int, ...]:
    """BASE and EXTRA of a whole text."""
    text = text or ""
    words = text.encode("utf-8", "surrogatepass").split()  # bytes.split knows just the six characters
    n = len(words)
    seen: set[str] = set()
    lines = dups = 0
    for line in text.split("\n"):
        if line.strip(SPACE):
            lines += 1
            if line in seen:
                dups += 1
            else:
                seen.add(line)
    covered = 0
    if n > 3:
        ids = np.fromiter(map(dict(zip(words, range(n), strict=True)).__getitem__, words), np.int64, n)
        a, b, c = ids[:-2], ids[1:-1], ids[2:]
        pair = np.unique(a * n + b, return_inverse=True)[1]
        _, place, times = np.unique(pair * n + c, return_inverse=True, return_counts=True)
        twice = times[place] > 1
        if twice.any():
            cover = np.zeros(n, bool)
            for k in range(3):
                cover[k: n - 2 + k] |= twice
            covered = int(cover.sum())
    return (n, len(text) - sum(map(text.count, SPACE)), sum(map(text.count, SYMBOLS)), dups, covered, lines, text.count("!"), sum(map(str.isupper, text)) if not text.islower() else 0)


def add_signals(docs: DataFrame, keep_text: bool = False) -> DataFrame:
    """Adds BASE and EXTRA long to docs, whose text goes unless keep_text."""
    names = [*BASE, *EXTRA]
    rest = [f for f in docs.schema.fields if (keep_text or f.name != "text") and f.name not in names]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = np.array([count_signals(t) for t in b.column("text").to_pylist()], np.int64).reshape(-1, len(names))
            yield pa.RecordBatch.from_arrays([b.column(f.name) for f in rest] + [pa.array(rows[:, k]) for k in range(len(names))], [*(f.name for f in rest), *names])

    return docs.mapInArrow(run, ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in rest] + [f"{n} long" for n in names]))


def base_failed() -> F.Column:
    """Too few words, or too many in repeated windows."""
    return (F.col("n_words") < 50) | (F.col("n_repeat_words") * 100 > F.col("n_words") * 50)


def rule_signals() -> dict[str, F.Column]:
    """The signal of each rule, as a column of the counts."""
    words, chars = F.greatest("n_words", F.lit(1)), F.greatest("word_chars", F.lit(1))
    return {
        "symbols_per_word": F.col("n_symbols") / words, "bangs_per_word": F.col("n_bangs") / words, "capitals_per_char": F.col("n_capitals") / chars,
        "dup_line_share": F.col("n_dup_lines") / F.greatest("n_lines", F.lit(1)), "repeat_word_share": F.col("n_repeat_words") / words, "chars_per_word": F.col("word_chars") / words,
    }


def binomial_tail(k: int, n: int, p: float) -> float:
    """P(X <= k) of a binomial X with n trials of probability p, exactly summed."""
    if not 0 < p < 1:
        return 1.0 if p <= 0 or k >= n else 0.0
    log = math.lgamma(n + 1)
    return min(1.0, math.fsum(math.exp(log - math.lgamma(i + 1) - math.lgamma(n - i + 1) + i * math.log(p) + (n - i) * math.log1p(-p)) for i in range(k + 1)))


def pick_cutoffs(counts: dict[str, list[int]], n: int, strata: int, alpha: float, delta: float) -> dict[str, float | None]:
    """The cutoffs of the tightest good level, None for all if there is none.

    counts: good holdout texts rejected at each level, whose sum over the keys counts as rejected; a shorter list goes on with its last.
    """
    picked: dict[str, float | None] = dict.fromkeys(RULES)
    error = delta / max(strata, 1)
    for k in range(LEVELS):
        above = min(n, sum(c[min(k, len(c) - 1)] for c in counts.values()))
        if above > alpha * n or binomial_tail(above, n, alpha) > error:
            break
        picked = {rule: cutoffs[min(k, len(cutoffs) - 1)] for rule, cutoffs in RULES.items()}
    return picked


def learn_cutoffs(signals: DataFrame, labels: DataFrame, stratum: str = "lang", alpha: float = 0.05, delta: float = 0.05) -> DataFrame:
    """Cutoffs by stratum: (stratum, a double a rule, null where the rule is off). signals may have TEXT."""
    good = labels.where("doc_id IS NOT NULL AND quality IS NOT NULL").groupBy(F.col("doc_id").alias("_id")).agg(F.min("quality").alias("_q")).where("_q = 1")
    held = signals.where(~base_failed()).join(good, F.col("doc_id") == F.col("_id"), "left_semi")
    if TEXT in signals.columns:
        held = held.dropDuplicates([stratum, TEXT])
    signal_of = rule_signals()
    tests = [F.count_if(reduce(operator.or_, (signal_of[r] > cs[min(k, len(cs) - 1)] for r, cs in RULES.items()))).alias(f"above_{k}") for k in range(LEVELS)]
    counts = materialize(held.groupBy(stratum).agg(F.count("*").alias("n"), *tests), "counts")
    strata = counts.count()
    kind = signals.schema[stratum].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = b.to_pylist()
            out = [pick_cutoffs({"any": [row[f"above_{k}"] for k in range(LEVELS)]}, row["n"], strata, alpha, delta) for row in rows]
            yield pa.RecordBatch.from_arrays([b.column(stratum), *(pa.array([o[r] for o in out], pa.float64()) for r in RULES)], [stratum, *RULES])

    return counts.mapInArrow(run, f"`{stratum}` {kind}, " + ", ".join(f"{r} double" for r in RULES))


def judge(signals: DataFrame, cutoffs: DataFrame, stratum: str = "lang") -> DataFrame:
    """Adds base_failed and kept. A stratum without cutoffs has the base rules alone."""
    cuts = cutoffs.select(F.col(stratum).alias("_stratum"), *(F.col(r).alias(f"_{r}") for r in RULES))
    joined = signals.join(cuts, F.col(stratum).eqNullSafe(F.col("_stratum")), "left")
    rejected = F.lit(False)
    for rule, signal in rule_signals().items():
        rejected = rejected | F.coalesce(signal > F.col(f"_{rule}"), F.lit(False))
    return joined.withColumn("base_failed", base_failed()).withColumn("kept", ~F.col("base_failed") & ~rejected).drop("_stratum", *(f"_{r}" for r in RULES))


def quality_verdicts(docs: DataFrame, labels: DataFrame, alpha: float = 0.05, delta: float = 0.05) -> DataFrame:
    """Signals, base_failed and kept for each row of docs (doc_id, text, lang); the text is dropped."""
    signals = materialize(add_signals(docs.select("doc_id", "text", "lang", F.xxhash64("text").alias(TEXT))), "signals")
    return judge(signals, learn_cutoffs(signals, labels, "lang", alpha, delta)).drop(TEXT)


def keep_quality(docs: DataFrame, labels: DataFrame, alpha: float = 0.05, delta: float = 0.05) -> DataFrame:
    """The rows of docs that the rules keep, with their columns as they are.

    Rows are told apart by the XXH64 of id, text and language: among N rows about N * N / 2^65 pairs would be taken for one.
    """
    keys = docs.select("doc_id", "text", "lang", F.xxhash64("doc_id", "text", "lang").alias("_row"), F.struct(*docs.columns).alias("doc"))
    signals = materialize(add_signals(keys.select("doc_id", "text", "lang", "_row", F.xxhash64("text").alias(TEXT))), "signals")
    kept = judge(signals, learn_cutoffs(signals, labels, "lang", alpha, delta)).where("kept").select("_row").distinct()
    return keys.select("_row", "doc").join(kept, "_row", "left_semi").select("doc.*")

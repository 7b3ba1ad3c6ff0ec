"""Packing documents into training windows by lexical retrieval.

Documents are routed by content to shards of about equal tokens: a tree of hyperplanes
cuts the space of their projected BM25 weights at gaps between alike documents, so copies
share a shard and most documents of one topic do; content that outgrows a shard is spread
over several. A shard holds a BM25 inverted index over token ids; idf and mean length come
from all documents. Neighbours in other shards aren't seen. A window starts with a seed
document, the index returns the shard's unused neighbours by score, and they fill the
window in that order. The document that the window's end cuts seeds the next window; if
none was cut, the first unused one does, as it does where no neighbour shares a term. So
only the last window of a shard isn't full.

Defined results: a null or empty text is a document of its end id alone; repeated rows
and null ids are documents of their own; an empty table gives no rows; other columns
aren't read. Documents longer than a window run over several.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialize
from .tokens import ids_of

K1, B = 1.2, 0.75
#: Neighbours that are sorted at once; the rest follow where a window needs them.
FIRST = 32
#: Dimensions of the vectors that route documents, and the documents for each shard that place the cuts.
DIMS, PER_SHARD = 32, 48


def token_table(docs: DataFrame, path: str, end_id: int) -> DataFrame:
    """Ids of each document, written to the shared folder: (row, doc_id, n_tokens, ids binary, df binary).

    row numbers rows across tasks. Ids are 16-bit where the vocabulary fits, else 32-bit. Each
    batch adds a row without n_tokens, whose df counts the documents that hold each id.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = ids_of(path)
        size = max(vocabulary.tokenizer.get_vocab_size(), end_id + 1)
        narrow = "<u2" if size <= 1 << 16 else "<u4"
        end, row = np.array([end_id], "<u4").tobytes(), TaskContext.get().partitionId() << 33
        for b in batches:
            df, held = np.zeros(size, np.int64), np.zeros(size, bool)
            out = []
            for text in b.column("text").to_pylist():
                ids = np.frombuffer(vocabulary.of(text) + end, "<u4")
                held[ids] = True
                found = np.flatnonzero(held)
                df[found] += 1
                held[found] = False
                out.append(ids.astype(narrow).tobytes())
            n = len(out)
            width = int(narrow[-1])
            yield pa.RecordBatch.from_arrays([
                pa.array([*range(row, row + n), None], pa.int64()), pa.concat_arrays([b.column("doc_id"), pa.nulls(1, b.column("doc_id").type)]),
                pa.array([*(len(x) // width for x in out), None], pa.int64()), pa.array([*out, None], pa.binary()), pa.array([None] * n + [df.tobytes()], pa.binary()),
            ], ["row", "doc_id", "n_tokens", "ids", "df"])
            row += n

    return materialize(docs.select("doc_id", "text").mapInArrow(run, f"row long, doc_id {kind}, n_tokens long, ids binary, df binary"), "tokens")


def inverse_frequencies(tokens: DataFrame) -> np.ndarray:
    """BM25's idf of every id, over all documents. The vector has the vocabulary's fixed length."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for b in batches:
            for df in b.column("df").to_pylist():
                total = np.frombuffer(df, np.int64) if total is None else total + np.frombuffer(df, np.int64)
        if total is not None:
            ids = np.flatnonzero(total)
            yield pa.RecordBatch.from_arrays([pa.array(ids), pa.array(total[ids])], ["id", "n"])

    parts = tokens.where("df IS NOT NULL").select("df").mapInArrow(add, "id long, n long").groupBy("id").agg(F.sum("n").alias("n")).toPandas()
    docs = tokens.where("n_tokens IS NOT NULL").count()
    df = np.zeros(int(parts["id"].max()) + 1 if len(parts) else 1)
    df[parts["id"].to_numpy(int)] = parts["n"]
    return np.log1p((docs - df + 0.5) / (df + 0.5)).astype(np.float32)


def projection(size: int) -> np.ndarray:
    """The fixed random direction of every id."""
    return np.random.default_rng(5).standard_normal((size, DIMS), np.float32)


def route_vector(ids: np.ndarray, idf: np.ndarray, mean: float, directions: np.ndarray) -> np.ndarray:
    """The projected BM25 weights of a document, of length 1."""
    terms, tf = distinct(ids)
    weight = idf[terms] * (tf * (K1 + 1) / (tf + K1 * (1 - B + B * len(ids) / mean))).astype(np.float32)
    vector = weight @ directions[terms]
    return vector / max(float(np.linalg.norm(vector)), 1e-9)


def grow_tree(vectors: np.ndarray, weights: np.ndarray, shards: int) -> list[tuple]:
    """Nodes from the root on: (direction, cut, node below, node above), or (None, first shard, shards) for a leaf.

    A node cuts its part along the widest direction, at the widest gap near the middle; each side gets
    shards by its weight. Vectors that can't be told apart share a leaf of several shards.
    """
    nodes: list[tuple] = []

    def grow(held: np.ndarray, first: int, n: int) -> int:
        at = len(nodes)
        nodes.append((None, first, n))
        if n == 1 or len(held) < 2:
            return at
        part = vectors[held]
        direction = np.linalg.eigh(np.cov(part.T.astype(float)))[1][:, -1].astype(np.float32)
        place = part @ direction
        order = np.argsort(place, kind="stable")
        share = np.cumsum(weights[held][order]) / weights[held].sum()
        gaps = np.diff(place[order])
        middle = (n // 2) / n
        apart = gaps > 1e-5
        near = apart & (np.abs(share[:-1] - middle) <= 0.1)
        if near.any():
            k = int(np.argmax(np.where(near, gaps, 0)))
        elif apart.any():
            k = int(np.argmin(np.where(apart, np.abs(share[:-1] - middle), 2)))
        else:
            return at
        cut = float(place[order[k]] + place[order[k + 1]]) / 2
        left = min(max(round(float(share[k]) * n), 1), n - 1)
        below = grow(held[place <= cut], first, left)
        nodes[at] = (direction, cut, below, grow(held[place > cut], first + left, n - left))
        return at

    grow(np.arange(len(vectors)), 0, shards)
    return nodes


def route(vectors: np.ndarray, rows: np.ndarray, nodes: list[tuple]) -> np.ndarray:
    """The shard of each vector; leaves of several shards deal by row."""
    shard = np.zeros(len(vectors), np.int64)
    stack = [(0, np.arange(len(vectors)))]
    while stack:
        node, held = stack.pop()
        if not len(held):
            continue
        if nodes[node][0] is None:
            _, first, n = nodes[node]
            shard[held] = first + rows[held] % n
            continue
        direction, cut, below, above = nodes[node]
        side = vectors[held] @ direction <= cut
        stack += [(below, held[side]), (above, held[~side])]
    return shard


def distinct(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct ids of a document and how often each comes."""
    ranked = np.sort(ids, kind="stable")  # a radix sort where ids have 16 bits
    first = np.flatnonzero(np.concatenate([[True], ranked[1:] != ranked[:-1]]))
    return ranked[first], np.diff(first, append=len(ranked))


class Index:
    """BM25 inverted index of one shard: postings by id, with the weight of the id in each document.

    Ids that over a DENSE-th of the documents hold have their weights in a dense row each, which is at
    most so many times as large as their postings.
    """

    DENSE = 4

    def __init__(self, docs: list[np.ndarray], idf: np.ndarray, mean: float):
        found = [distinct(d) for d in docs]
        self.terms = [t.astype(np.int64) for t, _ in found]
        sizes = np.array([len(t) for t in self.terms])
        term = np.concatenate(self.terms)
        tf = np.concatenate([c for _, c in found]).astype(np.float32)
        doc = np.repeat(np.arange(len(docs)), sizes)
        length = np.array([len(d) for d in docs], np.float32)
        norm = K1 * (1 - B + B * length / mean)
        weight = (idf[term] * tf * (K1 + 1) / (tf + norm[doc])).astype(np.float32)
        df = np.bincount(term, minlength=len(idf))
        often = np.flatnonzero(df * self.DENSE > len(docs))
        self.row = np.full(len(df), -1)
        self.row[often] = np.arange(len(often))
        row = self.row[term]
        dense = row >= 0
        self.dense = np.zeros((len(often), len(docs)), np.float32)
        self.dense[row[dense], doc[dense]] = weight[dense]
        order = np.argsort(term[~dense], kind="stable")
        self.doc, self.weight = doc[~dense][order], weight[~dense][order].astype(float)
        df[often] = 0
        self.at = np.concatenate([[0], np.cumsum(df)])
        self.n = self.held = len(docs)

    def compact(self, unused: np.ndarray) -> None:
        """Leaves out the postings of used documents once they are half of those held; scores of the others stay."""
        left = int(np.count_nonzero(unused))
        if 2 * left > self.held:
            return
        keep = unused[self.doc]
        self.at = np.concatenate([[0], np.cumsum(keep)])[self.at]
        self.doc, self.weight, self.held = self.doc[keep], self.weight[keep], left

    def scores(self, seed: int) -> np.ndarray:
        """The score of every document for all distinct ids of the seed."""
        terms = self.terms[seed]
        row = self.row[terms]
        total = self.dense[row[row >= 0]].sum(0)
        terms = terms[row < 0]
        lists = list(zip(self.at[terms].tolist(), self.at[terms + 1].tolist(), strict=True))
        if not lists:
            return total
        doc = np.concatenate([self.doc[a:b] for a, b in lists])
        return total + np.bincount(doc, np.concatenate([self.weight[a:b] for a, b in lists]), minlength=self.n)

    def nearest(self, seed: int, unused: np.ndarray) -> Iterator[int]:
        """Unused documents that share an id with the seed, best first; ties by place. The far ones are sorted only if asked for."""
        self.compact(unused)
        scores = self.scores(seed)
        scores[~unused] = 0
        near = np.flatnonzero(scores)
        cut = len(near) - FIRST
        bar = np.partition(scores[near], cut)[cut] if cut > 0 else 0.0
        for part in (near[scores[near] >= bar], near[scores[near] < bar]):
            yield from part[np.lexsort((part, -scores[part]))].tolist()


def fill_windows(docs: list[np.ndarray], idf: np.ndarray, mean: float, window: int) -> list[tuple[int, int, int, int, int]]:
    """Pieces (document, start, length, window number, offset) that cover every id once."""
    index = Index(docs, idf, mean)
    sizes = [len(d) for d in docs]
    unused = np.ones(len(docs), bool)
    pieces, number, offset, fresh = [], 0, 0, 0

    def put(d: int, start: int) -> int:
        nonlocal number, offset
        length = min(sizes[d] - start, window - offset)
        pieces.append((d, start, length, number, offset))
        offset += length
        if offset == window:
            number, offset = number + 1, 0
        return start + length

    seed, at = -1, 0
    while True:
        if seed < 0:
            while fresh < len(docs) and not unused[fresh]:
                fresh += 1
            if fresh == len(docs):
                return pieces
            seed, at = fresh, 0
            unused[seed] = False
        while at < sizes[seed]:
            at = put(seed, at)
        if not offset:  # the seed ended with its window
            seed = -1
            continue
        near, seed = index.nearest(seed, unused), -1
        for d in near:
            unused[d] = False
            at = put(d, 0)
            if not offset:
                if at < sizes[d]:
                    seed = d
                break


def pack_windows(docs: DataFrame, path: str, end_id: int = 2, window: int = 4096, shard_tokens: int = 4_000_000) -> DataFrame:
    """Pieces of all documents: (doc_id, start, length, ids, doc_tokens, sequence_id, offset).

    ids holds a piece's ids as little-endian unsigned 32-bit integers. path: a file of the
    tokenizers library. shard_tokens: about so many tokens share an index, which bounds a task.
    """
    spark = docs.sparkSession
    kind = docs.schema["doc_id"].dataType.simpleString()
    tokens = token_table(docs, path, end_id)
    real = tokens.where("n_tokens IS NOT NULL").select("row", "doc_id", "n_tokens", "ids")
    total, mean = real.agg(F.coalesce(F.sum("n_tokens"), F.lit(0)), F.coalesce(F.avg("n_tokens"), F.lit(1.0))).first()
    idf = spark.sparkContext.broadcast(inverse_frequencies(tokens))  # as long as the vocabulary, whatever the corpus
    shards = max(1, -(-total // shard_tokens))

    def pack(key: tuple, rows: pa.Table) -> pa.Table:
        rows = rows.sort_by("row")
        n, raw = rows.column("n_tokens").to_pylist(), rows.column("ids").to_pylist()
        parts = [np.frombuffer(x, f"<u{len(x) // k}") for x, k in zip(raw, n, strict=True)]
        pieces = fill_windows(parts, idf.value, mean, window)
        d, start, length, number, offset = (np.array(x, np.int64) for x in zip(*pieces, strict=True))
        return pa.table({
            "doc_id": rows.column("doc_id").take(pa.array(d)), "start": start, "length": length,
            "ids": pa.array([parts[i][s: s + k].astype("<u4").tobytes() for i, s, k, _, _ in pieces], pa.binary()),
            "doc_tokens": np.array(n, np.int64)[d], "sequence_id": (key[0].as_py() << 32) + number, "offset": offset,
        })

    def vectors_of(b: pa.RecordBatch, directions: np.ndarray) -> np.ndarray:
        raw = zip(b.column("ids").to_pylist(), b.column("n_tokens").to_pylist(), strict=True)
        return np.array([route_vector(np.frombuffer(x, f"<u{len(x) // n}"), idf.value, mean, directions) for x, n in raw], np.float32).reshape(-1, DIMS)

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        directions = projection(len(idf.value))
        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array([v.tobytes() for v in vectors_of(b, directions)], pa.binary()), b.column("n_tokens")], ["vector", "n_tokens"])

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        directions = projection(len(idf.value))
        for b in batches:
            shard = route(vectors_of(b, directions), b.column("row").to_numpy(zero_copy_only=False), tree.value)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(shard)], [*b.schema.names, "shard"])

    if shards == 1:
        dealt = real.withColumn("shard", F.lit(0).cast("long"))
    else:  # a sample places the cuts; every document is routed
        every = max(1, real.count() // (shards * PER_SHARD))
        sample = real.where(F.pmod(F.xxhash64("row"), F.lit(every)) == 0).mapInArrow(project, "vector binary, n_tokens long").collect()
        tree = spark.sparkContext.broadcast(grow_tree(np.array([np.frombuffer(r["vector"], np.float32) for r in sample]).reshape(-1, DIMS), np.array([float(r["n_tokens"]) for r in sample]), shards))
        dealt = real.mapInArrow(deal, f"row long, doc_id {kind}, n_tokens long, ids binary, shard long")
    return dealt.groupBy("shard").applyInArrow(pack, f"doc_id {kind}, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long")

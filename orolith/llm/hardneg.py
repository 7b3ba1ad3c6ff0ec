"""Hard negatives by one-dimensional distance keys.

Vectors of whole numbers get one more component, sqrt(M - |x|^2) with M the largest squared norm, so that all lie on a
sphere, and an anchor the component 0. Then the distance of an anchor q to x is |q|^2 + M - 2 q.x, squared: near means a high
inner product, and a range of scores is an annulus around q. Each vector's key is its nearest pivot and its distance
to that; the store is sorted by key and cut into blocks. Rings of a pivot are ranges of distances. By the triangle
inequality a ring bounds the scores of all that it holds, from the distances of q and of the ring to the pivot alone.

A search scans, in growing rounds, the rings that could hold the best scores of an anchor's ranges, and ends for an anchor once no ring
left can hold a score that is as high as the last of those found. So results are exact. First come the positives of
each anchor; their scores then give the ranges for its negatives.

Equal vectors of one label are one row of the store with their least ids, as many as a result can need, so a group of copies however large
weighs nothing. Rings that hold many blocks are dealt to several tasks. What the driver and broadcasts hold is bounded: PIVOTS pivots chosen from SAMPLE vectors, and
PIVOTS * RINGS rings. Spark goes by the size of packed files, which says little of the rows made from them, so all other joins are told to sort and merge.

Defined results: rows with a null label, a null vector, or a null or non-finite component take no part; a shorter vector
counts as filled up with zeros; repeated rows are rows of their own, also as anchors; a null id is no anchor and comes last among equal
scores; an empty table gives no rows; other columns aren't read. Labels are whole numbers. Scores must fit a long: where they don't, the job fails.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import materialize

#: Most pivots, and rings of a pivot; vectors from which pivots are chosen.
PIVOTS, RINGS, SAMPLE = 64, 64, 1024
#: Vectors of a block, anchors of a chunk, and blocks of a ring that one task meets, about.
BLOCK, CHUNK, DEALT = 1024, 256, 8
#: Rings of the first round; each round comes as far as so many times the one before.
FIRST, GROWTH = 8, 8
#: Stands for a null id.
LAST = (1 << 63) - 1


def whole_vectors(vectors: DataFrame, scale: int) -> DataFrame:
    """(vec_id, label, v): valid rows with each component x as floor(scale * x)."""
    sound = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != F.lit(float("inf"))))
    rows = vectors.where(F.col("label").isNotNull() & F.col("embedding").isNotNull() & sound)
    return rows.select(F.coalesce(F.col("vec_id").cast("long"), F.lit(LAST)).alias("vec_id"), F.col("label").cast("long").alias("label"), F.transform("embedding", lambda x: F.floor(x.cast("double") * scale)).alias("v"))


def distinct_vectors(rows: DataFrame, keep: int) -> DataFrame:
    """(label, v, ids): equal vectors of a label once, with their least ids. Each task cuts its part of a group first."""
    order = Window.partitionBy("label", "v").orderBy("vec_id")
    return rows.withColumn("_k", F.row_number().over(order)).where(F.col("_k") <= keep).groupBy("label", "v").agg(F.array_sort(F.collect_list("vec_id")).alias("ids"))


def matrix(lists: pa.Array, width: int) -> np.ndarray:
    """Lists of numbers as rows, filled up with zeros."""
    sizes = lists.value_lengths().to_numpy(zero_copy_only=False)
    out = np.zeros((len(lists), width), np.int64)
    out[np.arange(width) < sizes[:, None]] = lists.flatten().to_numpy(zero_copy_only=False)
    return out


class Space:
    """The sphere: pivots, and exact scores."""

    def __init__(self, sample: np.ndarray, most: int, count: int):
        self.most, self.width = most, sample.shape[1]
        wanted = int(np.clip(np.sqrt(count) / 4, 1, PIVOTS))
        chosen = [0]
        near = self.apart(sample, sample[:1])[:, 0]
        while len(chosen) < min(wanted, len(sample)) and near.max() > 0:  # the farthest from those chosen so far
            chosen.append(int(near.argmax()))
            near = np.minimum(near, self.apart(sample, sample[chosen[-1:]])[:, 0])
        self.pivots = sample[chosen]

    def scores(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Inner products of whole numbers: no sum of products passes most, so doubles are exact up to 2^53."""
        return np.rint(a.astype(float) @ b.T.astype(float)).astype(np.int64) if self.most < 1 << 53 else a @ b.T

    def rest(self, x: np.ndarray) -> np.ndarray:
        return np.sqrt(np.maximum(self.most - (x * x).sum(1), 0).astype(float))

    def apart(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Distances of stored vectors."""
        return np.sqrt(np.maximum(2.0 * self.most - 2 * (a.astype(float) @ b.T.astype(float) + np.outer(self.rest(a), self.rest(b))), 0))

    def from_pivots(self, q: np.ndarray) -> np.ndarray:
        """Distances of anchors, whose last component is 0, to the pivots."""
        return np.sqrt(np.maximum((q * q).sum(1)[:, None] + float(self.most) - 2.0 * self.scores(q, self.pivots), 0))


def keyed(rows: DataFrame, space: Space) -> DataFrame:
    """Adds pivot and distance, the key of the store."""
    names = rows.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            away = space.apart(matrix(b.column("v"), space.width), space.pivots)
            nearest = away.argmin(1)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(nearest.astype(np.int32)), pa.array(away[np.arange(len(away)), nearest])], [*names, "pivot", "distance"])

    return rows.mapInArrow(run, f"{', '.join(f'{f.name} {f.dataType.simpleString()}' for f in rows.schema.fields)}, pivot int, distance double")


def store_blocks(rows: DataFrame, space: Space, count: int) -> DataFrame:
    """The store, sorted by key: (ring, block, low, high, v, labels, ids, n_ids), a row for each block; numbers are packed."""
    per_pivot = int(np.clip(-(-count // (len(space.pivots) * BLOCK)), 1, RINGS))
    shares = [k / per_pivot for k in range(1, per_pivot)]
    edges = {r[0]: np.array(r[1] or []) for r in rows.groupBy("pivot").agg(F.percentile_approx("distance", shares, 10_000) if shares else F.lit(None)).collect()}
    dealt = rows.repartitionByRange(max(1, count // (BLOCK * DEALT)), "pivot", "distance", F.xxhash64("v")).sortWithinPartitions("pivot", "distance")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = TaskContext.get().partitionId() << 33
        for b in batches:
            pivot, distance = b.column("pivot").to_numpy(), b.column("distance").to_numpy()
            ring = np.array([p * RINGS + np.searchsorted(edges[p], d, side="right") for p, d in zip(pivot.tolist(), distance.tolist(), strict=True)], np.int64)
            starts = np.flatnonzero(np.concatenate([[True], ring[1:] != ring[:-1]])).tolist()
            for first, end in zip(starts, [*starts[1:], len(ring)], strict=True):
                for low in range(first, end, BLOCK):
                    part = b.slice(low, min(BLOCK, end - low))
                    at = distance[low: low + part.num_rows]
                    ids = part.column("ids")
                    packed = [matrix(part.column("v"), space.width), part.column("label").to_numpy(), ids.flatten().to_numpy(), ids.value_lengths().to_numpy().astype(np.int64)]
                    yield pa.RecordBatch.from_arrays([pa.array([ring[low]]), pa.array([block], pa.int64()), pa.array([at.min()]), pa.array([at.max()]), *(pa.array([x.astype("<i8").tobytes()], pa.binary()) for x in packed)], ["ring", "block", "low", "high", "v", "labels", "ids", "n_ids"])
                    block += 1

    return materialize(dealt.mapInArrow(run, "ring long, block long, low double, high double, v binary, labels binary, ids binary, n_ids binary"), "annuli")


def anchor_chunks(anchors: DataFrame, space: Space) -> DataFrame:
    """(chunk, q, q_labels, q_ids, anchor_ids): anchors that lie near each other, in rows of at most CHUNK."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunk = TaskContext.get().partitionId() << 33
        for b in batches:
            for low in range(0, b.num_rows, CHUNK):
                part = b.slice(low, CHUNK)
                ids = part.column("vec_id").to_numpy()
                packed = [matrix(part.column("v"), space.width), part.column("label").to_numpy(), ids]
                yield pa.RecordBatch.from_arrays([pa.array([chunk], pa.int64()), *(pa.array([x.astype("<i8").tobytes()], pa.binary()) for x in packed), pa.array([ids.tolist()], pa.list_(pa.int64()))], ["chunk", "q", "q_labels", "q_ids", "anchor_ids"])
                chunk += 1

    near = keyed(anchors, space)
    dealt = near.repartitionByRange("pivot", "distance", "vec_id").sortWithinPartitions("pivot", "distance")
    return materialize(dealt.mapInArrow(run, "chunk long, q binary, q_labels binary, q_ids binary, anchor_ids array<long>"), "anchors")


def _numbers(cell, width: int | None = None) -> np.ndarray:
    got = np.frombuffer(cell.as_py(), "<i8")
    return got if width is None else got.reshape(-1, width) if width else np.zeros((0, 0), np.int64)


class Search:
    """One kind of search: for positives one unbounded range of the same label, for negatives a range of other labels for each positive."""

    def __init__(self, space: Space, rings: list, negatives: bool, wanted: int, positives: int, low: int, high: int):
        self.space, self.negatives, self.wanted, self.slots = space, negatives, wanted, positives if negatives else 1
        self.low, self.high = low, high
        self.ring, self.near, self.far, self.deals = (np.array([r[k] for r in rings]) for k in ("ring", "low", "high", "deals"))

    def ranges(self, n: int, found: list[dict]) -> tuple[np.ndarray, np.ndarray]:
        """For each anchor and slot, the lowest and highest score that still counts; found holds the results so far."""
        least, most = np.full((n, self.slots), -LAST), np.full((n, self.slots), LAST)
        if self.negatives:
            least[:], most[:] = 1, 0  # empty
            for f in found:
                if f["slot"] == 0:
                    least[f["place"], f["rank"] - 1], most[f["place"], f["rank"] - 1] = -(-self.low * f["score"] // 100), self.high * f["score"] // 100
        for f in found:
            slot = f["slot"] - self.negatives
            if slot >= 0 and f["rank"] == self.wanted:
                least[f["place"], slot] = max(least[f["place"], slot], f["score"])
        return least, most

    def plan(self, rows: DataFrame, begin: int, end: int) -> DataFrame:
        """Rows of (ring, deal, chunk, places, q, labels, ids, least, most): the anchors of each chunk that still need a ring whose turn is from begin on, before end."""
        names = ["ring", "deal", "chunk", "places", "q", "q_labels", "q_ids", "least", "most"]

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                for i in range(b.num_rows):
                    chunk, ids = b.column("chunk")[i].as_py(), _numbers(b.column("q_ids")[i])
                    labels = _numbers(b.column("q_labels")[i])
                    q = np.frombuffer(b.column("q")[i].as_py(), "<i8").reshape(len(ids), self.space.width)
                    least, most = self.ranges(len(ids), b.column("found")[i].as_py() or [])
                    top, bottom = self.bounds(q)
                    turn = np.empty(top.shape, np.int64)
                    np.put_along_axis(turn, np.argsort(-np.minimum(top, most.max(1)[:, None].astype(float)), axis=1, kind="stable"), np.arange(top.shape[1])[None, :], 1)
                    needed = ((top[:, :, None] >= least[:, None, :]) & (bottom[:, :, None] <= most[:, None, :]) & (least <= most)[:, None, :]).any(2)
                    needed &= (turn >= begin) & (turn < end)
                    wanted = np.flatnonzero(needed.any(0)).tolist()
                    for low in range(0, len(wanted), 64):
                        out = []
                        for r in wanted[low: low + 64]:
                            at = np.flatnonzero(needed[:, r])
                            packed = [x.astype("<i8").tobytes() for x in (at, q[at], labels[at], ids[at], least[at], most[at])]
                            out += [(int(self.ring[r]), deal, chunk, *packed) for deal in range(self.deals[r])]
                        some = list(zip(*out, strict=True))
                        yield pa.RecordBatch.from_arrays([*(pa.array(c, pa.int64()) for c in some[:3]), *(pa.array(c, pa.binary()) for c in some[3:])], names)

        return rows.select("chunk", "q", "q_labels", "q_ids", "found").mapInArrow(run, "ring long, deal long, chunk long, places binary, q binary, q_labels binary, q_ids binary, least binary, most binary")

    def bounds(self, q: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For each anchor and ring, no score in the ring is above the first or below the second; roundings of distances are allowed for."""
        away = self.space.from_pivots(q)[:, self.ring // RINGS]
        norm = (q * q).sum(1)[:, None] + float(self.space.most)
        slack = norm * 1e-6 + 1
        nearest = np.maximum(np.maximum(away - self.far, self.near - away), 0)
        return (norm - nearest**2) / 2 + slack, (norm - (away + self.far) ** 2) / 2 - slack

    def scan(self, work: DataFrame, blocks: DataFrame) -> DataFrame:
        """(chunk, place, slot, score, id): the best of each block for each anchor and slot."""
        space, wanted = self.space, self.wanted

        def best(score: np.ndarray, at: np.ndarray, ids: list[np.ndarray], own: tuple[int, int] | None) -> list[tuple[int, int]]:
            """The first wanted (score, id) of the vectors at; own is the anchor's score and id with itself, left out once."""
            n = wanted + (own is not None)
            if len(at) > n:
                at = at[score[at] >= np.partition(score[at], -n)[-n]]
            pairs = sorted((-s, i) for s, k in zip(score[at].tolist(), at.tolist(), strict=True) for i in ids[k].tolist())
            if own is not None and (-own[0], own[1]) in pairs:  # else it isn't among the first
                pairs.remove((-own[0], own[1]))
            return pairs[:wanted]

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                out = []
                for i in range(b.num_rows):
                    cell = lambda name: _numbers(b.column(name)[i])  # noqa: B023, E731
                    places, labels, ids, chunk = cell("places"), cell("labels"), cell("ids"), b.column("chunk")[i].as_py()
                    x, q = (np.frombuffer(b.column(c)[i].as_py(), "<i8").reshape(n, space.width) for c, n in (("v", len(labels)), ("q", len(places))))
                    of_vector = np.split(ids, np.cumsum(cell("n_ids"))[:-1])
                    least, most = cell("least").reshape(len(places), -1), cell("most").reshape(len(places), -1)
                    all_scores, same = space.scores(q, x), cell("q_labels")[:, None] == labels
                    norms, x_norms = (q * q).sum(1), (x * x).sum(1)
                    for k, (place, own) in enumerate(zip(places.tolist(), cell("q_ids").tolist(), strict=True)):
                        score = all_scores[k]
                        fit = np.flatnonzero((same[k] ^ self.negatives) & (score >= least[k].min()) & (score <= most[k].max()))
                        for slot in range(self.slots):
                            at = fit[(score[fit] >= least[k, slot]) & (score[fit] <= most[k, slot])]
                            if len(at):
                                equal = at[(score[at] == norms[k]) & (x_norms[at] == norms[k])] if not self.negatives else at[:0]  # the anchor's own vector
                                mine = (int(norms[k]), own) if len(equal) and own in of_vector[equal[0]] else None
                                found = best(score, at, of_vector, mine)
                                out += [(chunk, place, slot + self.negatives, -s, i) for s, i in found]
                if out:
                    yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out, strict=True)], ["chunk", "place", "slot", "score", "id"])

        met = work.hint("merge").join(blocks, ["ring", "deal"]).select("chunk", "places", "q", "q_labels", "q_ids", "least", "most", "v", "labels", "ids", "n_ids")
        return met.mapInArrow(run, "chunk long, place long, slot long, score long, id long")


def choose_sample(stored: DataFrame, count: int, width: int) -> np.ndarray:
    """SAMPLE of count vectors, those of the least hashes, filled up with zeros.

    A limit after a sort would send as many vectors from each task to the driver; so only hashes that twice as many vectors have go there.
    """
    hashed = stored.select("v", F.xxhash64("v", "label").alias("h"))
    if count > 2 * SAMPLE:
        low = hashed.where(F.col("h") < F.lit(-(1 << 63) + (1 << 64) * 2 * SAMPLE // count))
        hashed = low if low.count() else hashed
    found = [v for v, _ in sorted(hashed.limit(4 * SAMPLE).collect(), key=lambda r: (r[1], r[0]))[:SAMPLE]]
    sample = np.zeros((len(found), width), np.int64)
    for k, v in enumerate(found):
        sample[k, : len(v)] = v
    return sample


def hard_negatives(vectors: DataFrame, anchor: Column, positives: int = 5, negatives: int = 3, low: int = 50, high: int = 95, scale: int = 256) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score) of vectors (vec_id, label, embedding).

    anchor: a condition on vec_id. Scores are inner products of floor(scale * component). An anchor's positives are
    the highest-scoring other rows of its label; for each, the negatives are the highest-scoring
    rows of other labels whose score is from low to high per cent of the positive's. Equal scores come by vec_id.
    """
    spark = vectors.sparkSession
    rows = materialize(whole_vectors(vectors, scale), "whole")
    stored = materialize(distinct_vectors(rows, max(positives + 1, negatives)), "stored")
    norm = F.aggregate("v", F.lit(0).cast("long"), lambda a, x: a + x * x)
    count, most, width = stored.agg(F.count("*"), F.coalesce(F.max(norm), F.lit(0)), F.coalesce(F.max(F.size("v")), F.lit(0))).first()
    schema = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
    if not count:
        return spark.createDataFrame([], schema)
    width = max(width, 1)
    sample = choose_sample(stored, count, width)
    space = Space(sample, most, count)
    blocks = store_blocks(keyed(stored, space), space, count)
    deals = F.ceil(F.count("*") / DEALT).cast("long").alias("deals")
    rings = blocks.groupBy("ring").agg(F.min("low").alias("low"), F.max("high").alias("high"), deals).collect()
    table = spark.createDataFrame([(r["ring"], r["deals"]) for r in rings], "ring long, deals long")
    dealt = blocks.join(F.broadcast(table), "ring").withColumn("deal", F.pmod(F.xxhash64("block"), F.col("deals"))).drop("deals", "block", "low", "high")
    chunks = anchor_chunks(rows.where((F.col("vec_id") != LAST) & anchor), space)
    found = None
    for kind, wanted in ((False, positives), (True, negatives)):
        search = Search(space, rings, kind, wanted, positives, low, high)
        begin, end = 0, FIRST
        while begin < len(rings):
            if found is None:
                work = chunks.withColumn("found", F.lit(None).cast("array<struct<place:long,slot:long,rank:int,score:long>>"))
            else:
                known = found.groupBy("chunk").agg(F.collect_list(F.struct("place", "slot", "rank", "score")).alias("found"))
                work = chunks.hint("merge").join(known, "chunk", "left")
            fresh = search.scan(search.plan(work, begin, end), dealt)
            both = fresh if found is None else fresh.unionByName(found.drop("rank"))
            order = Window.partitionBy("chunk", "place", "slot").orderBy(F.desc("score"), "id")
            most_kept = F.when(F.col("slot") == 0, positives).otherwise(negatives)
            found = materialize(both.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= most_kept), "found")
            begin, end = end, end * GROWTH
    ids = chunks.select("chunk", F.posexplode("anchor_ids").alias("place", "anchor_id")).withColumn("place", F.col("place").cast("long"))
    real = lambda c: F.nullif(F.col(c), F.lit(LAST))
    first = found.where("slot = 0").select("chunk", "place", F.col("rank").cast("long").alias("slot"), real("id").alias("positive_id"), F.col("score").alias("positive_score"))
    second = found.where("slot > 0").select("chunk", "place", "slot", "rank", real("id").alias("negative_id"), F.col("score").alias("negative_score"))
    return second.hint("merge").join(first, ["chunk", "place", "slot"]).hint("merge").join(ids, ["chunk", "place"]).select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")

"""Embedding near-duplicates by hierarchical navigable small-world graphs per shard.

Equal vectors collapse first. The distinct ones are dealt to shards by hash, and each shard
builds a graph. Every vector then queries every shard: a beam search descends the layers
and walks the bottom one. Audits come before, for each shard: vectors of the shard, moved to just the
similarity asked for, must be found again, and so must the links of sampled vectors of the shard
that a scan of all of it finds; the beam doubles until the shares found are high
enough, or the beam holds the whole shard. While all entries of a query's beam are links its beam doubles too, so no
number of links is a limit. What the graphs return is verified by cosine in double precision.

Two shards meet in one task, where each queries the other, so a link that either side finds
counts for both. Found links reduce to a spanning forest, and components are found over those.
No link leads out of a component, so links are counted inside components, by the
cosines of all pairs there: small ones go together to tasks, a large one is cut into parts that meet by twos.

Defined results: null vectors, zero vectors and such with null or non-finite components
link with nothing; vectors of other lengths don't link; repeated rows link with each
other; a vector without an id has no component and isn't kept; an empty table gives no
rows; other columns pass through, but for such with the names of results, which results replace.
Equal vectors are told by a 64-bit hash: among N distinct ones about N * N / 2^65 pairs would be taken for one.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import components, forest, materialize

#: Links of a node above and at the bottom layer, and the beam while building.
M, M0, BUILD = 12, 24, 48
#: Beam to begin with, audited vectors of a shard, share of them to be found, entries expanded in one step.
BEAM, AUDIT, RECALL, EXPAND = 48, 256, 0.995, 4
#: Queries that walk a graph in step.
STEP = 1024


#: Nodes of a component that count their links in one task; more are cut into parts.
PART = 2000
#: Partitions that shards, and pairs of such, are dealt to at most; beyond, some share a task one after the other.
MOST = 4000


def unit(x: np.ndarray) -> np.ndarray:
    """Rows of length 1; scaled first, so that squares neither overflow nor vanish."""
    x = x / np.abs(x).max(1, keepdims=True)
    return x / np.sqrt(np.einsum("ij,ij->i", x, x))[:, None]


def _fresh(ids: np.ndarray) -> np.ndarray:
    """Where an id is the first of its row; -1 never is."""
    order = np.argsort(ids, 1, kind="stable")
    ranked = np.take_along_axis(ids, order, 1)
    first = np.ones(ids.shape, bool)
    first[:, 1:] = ranked[:, 1:] != ranked[:, :-1]
    out = np.empty_like(first)
    np.put_along_axis(out, order, first, 1)
    return out & (ids >= 0)


def walk(q: np.ndarray, x: np.ndarray, links: np.ndarray, start: np.ndarray, beam: int) -> tuple[np.ndarray, np.ndarray]:
    """Beam search of rows of q in one layer from start (rows x entries): ids and similarities, best first; -1 fills."""
    n = len(q)
    ids = np.full((n, beam), -1, np.int32)
    sims = np.full((n, beam), -np.inf, np.float32)
    k = min(start.shape[1], beam)
    ids[:, :k] = start[:, :k]
    ids[:, :k][~_fresh(start[:, :k])] = -1
    sims[:, :k] = np.where(ids[:, :k] >= 0, np.einsum("nkd,nd->nk", x[ids[:, :k]], q), -np.inf)
    done = np.zeros((n, beam), bool)
    live = np.arange(n)
    while len(live):
        i, s, d = ids[live], sims[live], done[live]
        open_ = np.where(d | (i < 0), -np.inf, s)
        width = min(EXPAND, beam)
        pick = np.argpartition(-open_, width - 1, 1)[:, :width] if width < beam else np.argsort(-open_, 1)
        good = np.take_along_axis(open_, pick, 1) > -np.inf
        go = good.any(1)
        if not go.all():
            live, i, s, d, pick, good = live[go], i[go], s[go], d[go], pick[go], good[go]
            if not len(live):
                break
        np.put_along_axis(d, pick, np.take_along_axis(d, pick, 1) | good, 1)
        near = links[np.where(good, np.take_along_axis(i, pick, 1), -1)].reshape(len(live), -1)
        near[np.repeat(~good, links.shape[1], 1)] = -1
        both = np.concatenate([i, near], 1)
        fresh = _fresh(both)[:, beam:]
        worst = s.min(1)
        fs = np.where(fresh, np.einsum("nkd,nd->nk", x[near], q[live]), -np.inf).astype(np.float32)
        fs[fs <= worst[:, None]] = -np.inf
        alls = np.concatenate([s, fs], 1)
        top = np.argpartition(-alls, beam - 1, 1)[:, :beam]
        ts = np.take_along_axis(alls, top, 1)
        ids[live] = np.where(ts > -np.inf, np.take_along_axis(both, top, 1), -1)
        sims[live] = ts
        done[live] = np.take_along_axis(np.concatenate([d, np.zeros(near.shape, bool)], 1), top, 1)
    order = np.argsort(-sims, 1, kind="stable")
    return np.take_along_axis(ids, order, 1), np.take_along_axis(sims, order, 1)


def diverse(q: np.ndarray, x: np.ndarray, ids: np.ndarray, sims: np.ndarray, keep: int) -> np.ndarray:
    """Of each row's candidates (best first) those nearer to the row than to any chosen before, then the best others."""
    vectors = x[ids]
    among = np.einsum("nkd,nld->nkl", vectors, vectors)
    chosen = np.zeros(ids.shape, bool)
    for k in range(ids.shape[1]):
        blocked = (chosen & (among[:, k] > sims[:, k, None])).any(1)
        chosen[:, k] = (ids[:, k] >= 0) & ~blocked & (chosen.sum(1) < keep)
    rank = np.where(ids < 0, 3, np.where(chosen, 0, 1)) * ids.shape[1] + np.arange(ids.shape[1])
    order = np.argsort(rank, 1)[:, :keep]
    out = np.take_along_axis(ids, order, 1)
    return np.pad(out, ((0, 0), (0, keep - out.shape[1])), constant_values=-1)


class Graph:
    """A hierarchical navigable small-world graph of unit vectors (float32)."""

    def __init__(self, x: np.ndarray, seed: int = 7):
        self.x = x
        n = len(x)
        draws = np.random.default_rng(seed).random(n)
        level = np.minimum((-np.log(draws) / np.log(M)).astype(int), 6)
        order = np.argsort(-level, kind="stable")
        self.top = int(level[order[0]])
        self.entry = int(order[0])
        self.links = [np.full((n, M0 if k == 0 else M), -1, np.int32) for k in range(self.top + 1)]
        at = 0
        while at < n:  # nodes of higher layers come first; a batch is at most as large as what is there
            size = min(max(16, at), 512, n - at)
            self.insert(order[at: at + size], level, order[:at])
            at += size

    def descend(self, q: np.ndarray, lowest: int) -> np.ndarray:
        start = np.full((len(q), 1), self.entry, np.int32)
        for k in range(self.top, lowest, -1):
            start = walk(q, self.x, self.links[k], start, 4)[0][:, :1]
        return start

    def insert(self, new: np.ndarray, level: np.ndarray, old: np.ndarray) -> None:
        x = self.x
        for k in range(min(self.top, int(level[new].max())), -1, -1):
            here = new[level[new] >= k]
            q = x[here]
            ids, sims = np.full((len(here), 0), -1, np.int32), np.zeros((len(here), 0), np.float32)
            if len(old):
                ids, sims = walk(q, x, self.links[k], self.descend(q, k), BUILD)
            among = q @ q.T  # those of the batch aren't in the graph yet
            np.fill_diagonal(among, -np.inf)
            best = np.argsort(-among, 1, kind="stable")[:, :BUILD]
            ids = np.concatenate([ids, here[best].astype(np.int32)], 1)
            sims = np.concatenate([sims, np.take_along_axis(among, best, 1)], 1)
            ids[~np.isfinite(sims)] = -1
            top = np.argsort(-sims, 1, kind="stable")[:, :BUILD]
            ids, sims = np.take_along_axis(ids, top, 1), np.take_along_axis(sims, top, 1)
            width = self.links[k].shape[1]
            self.links[k][here] = diverse(q, x, ids, sims, width)
            self.link_back(k, here)

    def link_back(self, k: int, new: np.ndarray) -> None:
        """Nodes that new ones link to link to them too, and choose again among all."""
        links = self.links[k]
        to = links[new].ravel()
        source = np.repeat(new, links.shape[1])[to >= 0]
        to = to[to >= 0]
        order = np.argsort(to, kind="stable")
        to, source = to[order], source[order]
        targets, first, count = np.unique(to, return_index=True, return_counts=True)
        for part in range(0, len(targets), 256):
            t, f, c = targets[part: part + 256], first[part: part + 256], count[part: part + 256]
            wide = np.full((len(t), int(c.max())), -1, np.int32)
            row = np.repeat(np.arange(len(t)), c)
            wide[row, np.arange(c.sum()) - np.repeat(np.cumsum(c) - c, c)] = source[f[0]: f[0] + c.sum()]
            ids = np.concatenate([links[t], wide], 1)
            ids[~_fresh(ids)] = -1
            sims = np.where(ids >= 0, np.einsum("nkd,nd->nk", self.x[ids], self.x[t]), -np.inf)
            top = np.argsort(-sims, 1, kind="stable")[:, : 2 * links.shape[1] + 8]
            links[t] = diverse(self.x[t], self.x, np.take_along_axis(ids, top, 1), np.take_along_axis(sims, top, 1), links.shape[1])

    def search(self, q: np.ndarray, beam: int) -> tuple[np.ndarray, np.ndarray]:
        return walk(q, self.x, self.links[0], self.descend(q, 0), beam)

    def audited_beam(self, threshold: float, seed: int = 11) -> int:
        """The least doubled beam that finds vectors moved to the threshold, and the real links of sampled vectors, again."""
        rng = np.random.default_rng(seed)
        n = len(self.x)
        picked = rng.choice(n, min(AUDIT, n), replace=False)
        noise = rng.standard_normal((len(picked), self.x.shape[1]))
        base = self.x[picked].astype(float)
        side = noise - np.einsum("ij,ij->i", noise, base)[:, None] * base
        length = np.sqrt(np.einsum("ij,ij->i", side, side))
        side = np.where(length[:, None] > 0, side / np.maximum(length, 1e-12)[:, None], 0)
        near = min(threshold + 1e-6, 1.0)
        planted = unit(near * base + np.sqrt(1 - near * near) * side).astype(np.float32)
        real = self.x[picked]
        links = np.concatenate([np.zeros(0, np.int64), *(i * n + np.flatnonzero(self.x @ real[i] >= threshold) for i in range(len(picked)))])
        beam = BEAM
        while beam < n:
            ids, _ = self.search(planted, beam)
            rows, nodes = self.links_of(real, threshold, beam)
            if (ids == picked[:, None]).any(1).mean() >= RECALL and np.isin(links, rows * n + nodes).mean() >= RECALL:
                break
            beam *= 2
        return min(beam, max(n, 1))

    def links_of(self, q: np.ndarray, threshold: float, beam: int) -> tuple[np.ndarray, np.ndarray]:
        """Pairs (query, node) that may be links; a query whose beam is full of them walks again with twice the beam."""
        rows, nodes, low, n = [], [], np.float32(threshold - 1e-4), len(self.x)
        todo, beam = np.arange(len(q)), min(beam, n)
        while len(todo):
            again = []
            step = max(1, STEP * BEAM // beam)
            for part in (todo[i: i + step] for i in range(0, len(todo), step)):
                ids, sims = self.search(q[part], beam)
                full = (sims[:, -1] >= low) & (beam < n)
                r, c = np.nonzero((sims >= low) & ~full[:, None] & (ids >= 0))
                rows.append(part[r])
                nodes.append(ids[r, c])
                again.append(part[full])
            todo, beam = np.concatenate(again), min(beam * 2, n)
        return np.concatenate([np.zeros(0, np.int64), *rows]), np.concatenate([np.zeros(0, np.int64), *nodes])


def shard_links(nodes: DataFrame, threshold: float = 0.95, shards: int = 8, shard_bytes: int = 64 << 20) -> DataFrame:
    """For distinct vectors (node long, dim int, vector array<double>): links (a, b) that connect the same nodes as all found do.

    shards: at least so many for each length of vectors, more where one would exceed shard_bytes, of which a task holds a few.
    """
    sizes = nodes.groupBy(F.col("dim").alias("_dim")).agg(F.greatest(F.lit(shards), F.ceil(F.count("*") * F.col("_dim") * 8 / shard_bytes)).cast("int").alias("n"))
    total = sizes.agg(F.coalesce(F.sum("n"), F.lit(1))).first()[0]  # few bytes a shard, much work: each gets a task
    dealt = nodes.join(sizes, F.col("dim") == F.col("_dim")).withColumn("shard", F.pmod(F.xxhash64(F.col("node") + 1), F.col("n")).cast("int")).drop("_dim").repartition(min(total, MOST), "dim", "shard")

    def build(key: tuple, rows: pa.Table) -> pa.Table:
        rows = rows.sort_by("node")
        x = unit(rows.column("vector").combine_chunks().flatten().to_numpy().reshape(rows.num_rows, -1))
        graph = Graph(x.astype(np.float32))
        meta = np.array([graph.top, graph.entry, graph.audited_beam(threshold)], np.int64)
        parts = [meta.tobytes(), rows.column("node").to_numpy().tobytes(), x.tobytes(), *(a.tobytes() for a in graph.links)]
        return pa.table({"dim": pa.array([key[0].as_py()], pa.int32()), "n": rows.column("n").slice(0, 1), "shard": pa.array([key[1].as_py()], pa.int32()), "parts": pa.array([parts], pa.list_(pa.binary()))})

    graphs = materialize(dealt.groupBy("dim", "shard").applyInArrow(build, "dim int, n int, shard int, parts array<binary>"), "graphs")
    pairs = graphs.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("n") - 1))).withColumn("i", F.least("shard", "other")).withColumn("j", F.greatest("shard", "other"))

    def meet(rows: pa.Table) -> pa.Table:
        dim, sides = rows.column("dim")[0].as_py(), []
        for meta, own, x, *links in rows.column("parts").to_pylist():
            graph = Graph.__new__(Graph)
            graph.top, graph.entry, beam = np.frombuffer(meta, np.int64).tolist()
            x = np.frombuffer(x).reshape(-1, dim)
            graph.x = x.astype(np.float32)
            own = np.frombuffer(own, np.int64)
            graph.links = [np.frombuffer(a, np.int32).reshape(len(own), -1) for a in links]
            sides.append((graph, beam, own, x))
        alone = rows.column("i")[0] == rows.column("j")[0]
        held, size = [], 0
        for (_, _, ids, q), (graph, beam, own, x) in [sides * 2] if alone else list(zip(sides, sides[::-1], strict=True)) if len(sides) > 1 else []:
            for at in range(0, len(q), 4 * STEP):
                r, c = graph.links_of(graph.x[at: at + 4 * STEP] if alone else q[at: at + 4 * STEP].astype(np.float32), threshold, beam)
                r = r + at
                true = np.concatenate([np.zeros(0, bool), *(np.einsum("ij,ij->i", q[r[i: i + 65536]], x[c[i: i + 65536]]) >= threshold for i in range(0, len(r), 65536))])
                true &= ids[r] != own[c]
                held.append((ids[r[true]], own[c[true]]))
                size += len(held[-1][0])
                if size > 1 << 20:
                    held, size = [forest(*(np.concatenate(s) for s in zip(*held, strict=True)))], 0
        u, v = forest(*(np.concatenate(s) for s in zip(*held, strict=True))) if held else (np.zeros(0, np.int64),) * 2
        return pa.table({"a": u, "b": v})

    pairs = pairs.repartition(min(total * (total + 1) // 2, MOST), "dim", "i", "j")
    return materialize(pairs.groupBy("dim", "i", "j").applyInArrow(meet, "a long, b long"), "links")


def count_links(members: DataFrame, threshold: float) -> DataFrame:
    """Links of each node of components of two and more (node, component, times, vector) with their repetitions: (node, links)."""
    parts = members.groupBy("component").agg(F.ceil(F.count("*") / PART).cast("int").alias("parts"))
    rows = members.join(parts.withColumnRenamed("component", "_c"), F.col("component") == F.col("_c")).drop("_c")
    own = F.pmod(F.xxhash64("node"), F.col("parts")).cast("int")
    others = F.transform(F.sequence(F.lit(0), F.col("parts") - 1), lambda k: F.struct(F.least(k, own).alias("i"), F.greatest(k, own).alias("j")))
    dealt = rows.withColumn("meet", F.explode(others)).withColumn("part", own)
    dealt = dealt.withColumn("bucket", F.when(F.col("parts") > 1, F.col("component")).otherwise(F.pmod(F.xxhash64("component"), F.lit(max(1, members.count() // PART)))))

    def count(key: tuple, rows: pa.Table) -> pa.Table:
        cross = key[1] != key[2]  # pairs of one part meet elsewhere
        rows = rows.sort_by([("component", "ascending"), ("part", "ascending"), ("node", "ascending")])
        node, times, component, part = (rows.column(c).to_numpy() for c in ("node", "times", "component", "part"))
        vectors, n = rows.column("vector").combine_chunks(), np.zeros(len(node), np.int64)
        at = [0, *(np.flatnonzero(component[1:] != component[:-1]) + 1).tolist(), len(node)]
        for low, high in zip(at[:-1], at[1:], strict=True):
            x = unit(vectors.slice(low, high - low).flatten().to_numpy().reshape(high - low, -1))
            cut = low + int(np.count_nonzero(part[low:high] == part[low]))
            for k in range(low, cut if cross else high, 512):
                upto, first = min(k + 512, cut if cross else high), cut if cross else low
                linked = x[k - low: upto - low] @ x[first - low:].T >= threshold
                if not cross:
                    linked[np.arange(upto - k), np.arange(k - low, upto - low)] = False
                else:
                    n[first:high] += times[k:upto] @ linked
                n[k:upto] += linked @ times[first:high]
        return pa.table({"node": node, "n": n})

    counted = dealt.select("bucket", "meet", "component", "part", "node", "times", "vector").groupBy("bucket", "meet.i", "meet.j").applyInArrow(count, "node long, n long")
    return counted.groupBy("node").agg(F.sum("n").alias("links"))


def near_duplicates(vectors: DataFrame, threshold: float = 0.95, shards: int = 8) -> DataFrame:
    """Adds n_links, component_id and kept to (vec_id, embedding, ...)."""
    vectors = vectors.drop("n_links", "component_id", "kept", "_v", "_node", "_n")
    good = F.col("embedding").isNotNull() & F.forall("_v", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf"))) & F.exists("_v", lambda c: c != 0)
    rows = vectors.withColumn("_v", F.transform("embedding", lambda c: c.cast("double") + 0.0)).withColumn("_node", F.when(good & F.col("vec_id").isNotNull(), F.xxhash64("_v")))
    nodes = materialize(rows.where("_node IS NOT NULL").groupBy("_node").agg(F.count("*").alias("times"), F.min("vec_id").alias("least"), F.first("_v").alias("vector")).select(F.col("_node").alias("node"), "times", "least", F.size("vector").alias("dim"), "vector"), "nodes")
    found = components(shard_links(nodes.select("node", "dim", "vector"), threshold, shards)).withColumnRenamed("node", "_g")
    named = nodes.join(found, F.col("node") == F.col("_g"), "left").withColumn("root", F.coalesce("component", "node"))
    linked = materialize(named.where("component IS NOT NULL").select("component").distinct(), "linked")  # a component's least node isn't listed
    members = materialize(named.join(linked.withColumnRenamed("component", "_l"), F.col("root") == F.col("_l"), "left_semi").select("node", F.col("root").alias("component"), "times", "vector"), "members")
    links = count_links(members, threshold).withColumnRenamed("node", "_a")
    named = named.join(links, F.col("node") == F.col("_a"), "left")
    named = materialize(named.select("node", (F.col("times") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"), "least", "root"), "named")
    heads = named.groupBy("root").agg(F.min("least").alias("component_id"))
    result = named.join(heads, "root").select(F.col("node").alias("_n"), "n_links", "component_id")
    joined = rows.drop("_v").join(result, F.col("_node") == F.col("_n"), "left").drop("_n", "_node")
    component = F.coalesce("component_id", "vec_id")
    return joined.withColumn("n_links", F.coalesce("n_links", F.lit(0)).cast("long")).withColumn("component_id", component).withColumn("kept", F.coalesce(F.col("vec_id") == component, F.lit(False)))

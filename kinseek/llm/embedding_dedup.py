"""Embedding near-dedup by hierarchical navigable small-world graphs, one for each shard.

Equal vectors of a label become one class with a weight, so copies cost nothing. Classes of a
label are hashed into shards of at most `SHARD_ROWS`; a task builds a shard's graph, and every
vector of the label queries every shard. A query walks the graph with a beam, then goes on
from every vector found over the threshold until no new one turns up, so a group of
thousands is found whole. Queries drawn by hash are compared with brute force over their
shard; the beam is doubled, and the shard queried anew, until this audit passes. Cosines are
taken in double precision. Only links between vectors that a task has not joined yet leave it.

Defined results: vectors that are null, empty, zero or hold null or non-finite components,
and rows without a label, link with nothing and keep themselves; vectors of different length do not
link; equal rows are copies that link; rows with equal ids are vectors of their own; an
empty table gives no rows; extra columns do not matter.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kinseek.llm import graph
from kinseek.runtime import stage

SHARD_ROWS = 20_000
NEIGHBOURS = 12  # links of a vector above the lowest layer; twice as many on it
BUILD_BEAM, FIRST_BEAM = 40, 24
AUDITS, RECALL = 48, 0.995
KEYS = ["label", "dim", "shard"]


class Graph:
    """A navigable small-world graph over the rows of `vectors`, all of length 1."""

    def __init__(self, vectors: np.ndarray, seed: int) -> None:
        self.v = vectors
        count = len(vectors)
        draw = np.random.Generator(np.random.PCG64(seed)).random(count)
        self.levels = np.minimum((-np.log(draw) / np.log(NEIGHBOURS)).astype(int), 6)
        self.links: list[list[dict | list]] = []
        self.layers: list[dict[int, np.ndarray]] = [{} for _ in range(int(self.levels.max(initial=0)) + 1)]
        self.entry = -1
        self.seen = np.zeros(count, np.int64)
        self.tick = 0
        for i in range(count):
            self._insert(i)

    def beam(self, q: np.ndarray, entries: list[int], width: int, layer: int) -> list[tuple[float, int]]:
        """The `width` nearest vectors a walk from `entries` meets, nearest first."""
        self.tick += 1
        seen, tick, links = self.seen, self.tick, self.layers[layer]
        seen[entries] = tick
        near = self.v[entries] @ q
        todo = [(-s, e) for s, e in zip(near.tolist(), entries)]
        heapq.heapify(todo)
        best = [(-s, e) for s, e in todo]
        heapq.heapify(best)
        while len(best) > width:
            heapq.heappop(best)
        while todo:
            s, e = heapq.heappop(todo)
            if len(best) >= width and -s < best[0][0]:
                break
            around = links[e]
            around = around[seen[around] != tick]
            if not len(around):
                continue
            seen[around] = tick
            for near, other in zip((self.v[around] @ q).tolist(), around.tolist()):
                if len(best) < width:
                    heapq.heappush(best, (near, other))
                elif near > best[0][0]:
                    heapq.heapreplace(best, (near, other))
                else:
                    continue
                heapq.heappush(todo, (-near, other))
        return sorted(best, reverse=True)

    def _spread(self, i: int, found: np.ndarray, most: int) -> np.ndarray:
        """Neighbours of `i` out of `found`: near ones that no chosen one is nearer to."""
        near = self.v[found] @ self.v[i]
        order = np.argsort(-near, kind="stable")
        found, near = found[order], near[order]
        if len(found) <= most:
            return found
        among = self.v[found] @ self.v[found].T
        chosen, closest = [], np.full(len(found), -2.0)
        for k in range(len(found)):
            if near[k] >= closest[k]:
                chosen.append(k)
                if len(chosen) == most:
                    break
                np.maximum(closest, among[k], out=closest)
        if len(chosen) < most:
            rest = [k for k in range(len(found)) if k not in set(chosen)]
            chosen += rest[: (most - len(chosen)) // 2 + 1]
        return found[chosen[:most]]

    def _insert(self, i: int) -> None:
        q, top = self.v[i], int(self.levels[i])
        if self.entry < 0:
            for layer in range(top + 1):
                self.layers[layer][i] = np.zeros(0, np.int64)
            self.entry = i
            return
        high = int(self.levels[self.entry])
        at = [self.entry]
        for layer in range(high, top, -1):
            at = [self.beam(q, at, 1, layer)[0][1]]
        for layer in range(min(high, top), -1, -1):
            found = [e for _, e in self.beam(q, at, BUILD_BEAM, layer)]
            most = NEIGHBOURS * (2 if layer == 0 else 1)
            links = self.layers[layer]
            links[i] = self._spread(i, np.array(found, np.int64), NEIGHBOURS)
            for other in links[i].tolist():
                grown = np.append(links[other], i)
                links[other] = grown if len(grown) <= most else self._spread(other, grown, most)
            at = found
        for layer in range(high + 1, top + 1):
            self.layers[layer][i] = np.zeros(0, np.int64)
        if top > high:
            self.entry = i

    def over(self, q: np.ndarray, width: int, least: float) -> np.ndarray:
        """Vectors found with a cosine of at least `least`."""
        at = [self.entry]
        for layer in range(int(self.levels[self.entry]), 0, -1):
            at = [self.beam(q, at, 1, layer)[0][1]]
        found = [e for s, e in self.beam(q, at, width, 0) if s >= least]
        if not found:
            return np.zeros(0, np.int64)
        # From here on the walk has no beam: it ends when no neighbour is over the threshold.
        # The beam has dropped vectors over the threshold where there were too many: look anew.
        self.tick += 1
        links, tick = self.layers[0], self.tick
        self.seen[found] = tick
        out, todo = [np.array(found, np.int64)], found
        while todo:
            around = np.unique(np.concatenate([links[e] for e in todo]))
            around = around[self.seen[around] != tick]
            self.seen[around] = tick
            fresh = around[self.v[around] @ q >= least]
            out.append(fresh)
            todo = fresh.tolist()
        return np.concatenate(out)


def _cosines(raw: np.ndarray, norms: np.ndarray, i: np.ndarray, norm: float, found: np.ndarray) -> np.ndarray:
    return (raw[found] @ i) / (norms[found] * norm)


class _Shard:
    def __init__(self, ids: list[int], weights: np.ndarray, raw: np.ndarray, least: float) -> None:
        self.ids, self.weights, self.raw, self.least = ids, weights, raw, least
        self.norms = np.sqrt((raw * raw).sum(1))
        self.graph = Graph(raw / self.norms[:, None], 1 + len(ids))

    def links(self, q: np.ndarray, norm: float, width: int) -> np.ndarray:
        found = self.graph.over(q / norm, width, self.least - 1e-9)
        return found[_cosines(self.raw, self.norms, q, norm, found) >= self.least]

    def width(self, asked: np.ndarray) -> int:
        """The beam with which the audited ones of `asked` find their links."""
        pick = asked[np.linspace(0, len(asked) - 1, min(AUDITS, len(asked))).astype(int)]
        norms = np.sqrt((pick * pick).sum(1))
        truth = [np.flatnonzero(_cosines(self.raw, self.norms, q, n, np.arange(len(self.ids))) >= self.least) for q, n in zip(pick, norms)]
        width = FIRST_BEAM
        while width < len(self.ids):
            got = sum(len(np.intersect1d(t, self.links(q, n, width))) for t, q, n in zip(truth, pick, norms))
            if got >= RECALL * sum(map(len, truth)):
                break
            width *= 2
        return width


def _asker(least: float):
    schema = ["vec_id", "other", "links"]

    def ask(shard: _Shard, ids: list[int], raw: np.ndarray, met: graph.Forest, own: bool) -> pa.RecordBatch:
        width = shard.width(raw)
        counts = np.zeros(len(ids), np.int64)
        for k, (vec, q) in enumerate(zip(ids, raw)):
            found = shard.links(q, float(np.sqrt(q @ q)), width)
            if own:
                found = found[found != k]
            counts[k] = shard.weights[found].sum()
            for other in found.tolist():
                met.join(vec, shard.ids[other])
        return pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.nulls(len(ids), pa.int64()), pa.array(counts)], schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        met, key, held, shard = graph.Forest(), None, [], None

        def build() -> Iterator[pa.RecordBatch]:
            nonlocal shard
            if held and shard is None:
                ids = [i for part in held for i in part[0]]
                shard = _Shard(ids, np.concatenate([p[1] for p in held]), np.concatenate([p[2] for p in held]), least)
                yield ask(shard, ids, shard.raw, met, own=True)

        for batch in batches:
            keys = [tuple(x) for x in zip(*[batch.column(c).to_pylist() for c in [*KEYS, "asks"]])]
            at = 0
            while at < len(keys):
                end = at + 1
                while end < len(keys) and keys[end] == keys[at]:
                    end += 1
                if keys[at][:3] != key:
                    yield from build()
                    key, held, shard = keys[at][:3], [], None
                part = batch.slice(at, end - at)
                ids = part.column("vec_id").to_pylist()
                raw = np.asarray(part.column("embedding").flatten(), np.float64).reshape(len(ids), -1)
                if keys[at][3]:
                    yield from build()
                    yield ask(shard, ids, raw, met, own=False)
                else:
                    held.append((ids, part.column("weight").to_numpy(), raw))
                at = end
        yield from build()
        rows = list(met.pairs())
        yield pa.RecordBatch.from_arrays(
            [pa.array([b for _, b in rows], pa.int64()), pa.array([a for a, _ in rows], pa.int64()), pa.array([0] * len(rows), pa.int64())], schema
        )

    return run


def near_vectors(vectors: DataFrame, least: float = 0.93, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """`vec_id, n_links, component_id, kept` of every row of `vectors` (vec_id, embedding, label)."""
    item = F.col("embedding").cast("array<double>")
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    able = F.coalesce(
        F.col("label").isNotNull() & F.col("vec_id").isNotNull() & (F.size("embedding") > 0) & finite & F.exists("embedding", lambda x: x != 0),
        F.lit(False),
    )
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), item.alias("embedding"), F.col("label").cast("string").alias("label")).withColumn("_able", able)
    usable = rows.where("_able").withColumn("_hash", F.xxhash64("embedding"))
    same = ["label", "_hash", "embedding"]
    classes = stage(usable.groupBy(*same).agg(F.min("vec_id").alias("rep"), F.count(F.lit(1)).alias("weight")))
    groups = classes.groupBy("label", F.size("embedding").alias("dim")).agg(F.count(F.lit(1)).alias("_rows"))
    shards = F.ceil(F.col("_rows") / F.lit(shard_rows)).cast("int")
    placed = (
        classes.withColumn("dim", F.size("embedding"))
        .join(groups, ["label", "dim"])
        .withColumn("shards", shards)
        .withColumn("_home", F.pmod(F.xxhash64("rep", "_hash"), F.col("shards")).cast("int"))
        .select("label", "dim", F.col("rep").alias("vec_id"), "weight", "embedding", "_home", F.explode(F.sequence(F.lit(0), F.col("shards") - 1)).alias("shard"))
        .withColumn("asks", (F.col("shard") != F.col("_home")).cast("int"))
        .drop("_home")
    )
    keys = [*KEYS, "asks"]
    # With a number, as otherwise the small shards would be put together again in a few tasks.
    count = int(vectors.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    asked = placed.repartition(count, *KEYS).sortWithinPartitions(*keys, "vec_id").select(*keys, "vec_id", "weight", "embedding")
    found = stage(asked.mapInArrow(_asker(least), "vec_id long, other long, links long"))
    links = found.where("other is null").groupBy(F.col("vec_id").alias("rep")).agg(F.sum("links").alias("_links"))
    joined = graph.components(found.where("other is not null").select(F.col("vec_id").alias("a"), F.col("other").alias("b")))
    done = (
        classes.join(links, "rep", "left")
        .join(joined.withColumnRenamed("node", "rep"), "rep", "left")
        .select(*same, (F.coalesce("_links", F.lit(0)) + F.col("weight") - 1).alias("n_links"), F.coalesce("component", "rep").alias("component_id"))
    )
    out = ["vec_id", "n_links", "component_id", (F.col("vec_id") == F.col("component_id")).alias("kept")]
    alone = rows.where(~F.col("_able")).select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"), F.lit(True).alias("kept"))
    return usable.join(done, same).select(*out).union(alone)

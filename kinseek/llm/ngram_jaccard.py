"""N-gram Jaccard join: groups documents whose word shingle sets overlap enough.

1. Every document's set is profiled: its size, a 128-bit signature (equal sets share it), a
   64-cell histogram. Documents with the same set are one class from here on.
2. All shingles get one global order: those of rarer hash buckets first. The counts cover
   the whole corpus and take 65,536 numbers whatever its size.
3. A pair over the threshold shares one of the first n - ceil(t n) + 1 shingles of both.
   Sets of over 512 are compared in 2, 4, ... parts by hash: in one of them at least the two
   differ by no more than the part's share, so they share one of its first shingles.
   Classes that share one are compared by length, place and histogram, all of them bounds that
   no true pair can miss; what remains is joined to candidate groups. (Parts are never nearly
   empty: they have 256 shingles or more on average, at least a third of which must be there.)
4. The whole sets of a candidate group are stored in a trie and every set walks it, sharing
   partial overlaps; a subtree goes when the lengths that remain in it cannot reach the
   overlap, or when all its sets are linked with the walking one already.

Hot shingles and large candidate groups are split into blocks and pairs of blocks. No link is
sent on that joins what is joined already, so copies never become pairs.

Defined results: a null or wordless text has an empty set and links with nothing; texts with
fewer words than a shingle have one shingle; a null id keeps its row, with a null component
of its own; repeated ids are one node, which has the links of all its texts (there, different texts
are told apart by a 64-bit hash); extra columns do not matter.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from kinseek.llm import graph, words
from kinseek.runtime import stage

BUCKETS = 1 << 16
PART = 512  # shingles of a part at most, on average
CELLS, WALK_CELLS = 64, 256
GROUP_ROWS = 2048  # rows of one shingle compared in one go
BLOCK_SHINGLES = 4_000_000  # shingles of one trie
BROADCAST_IDS = 200_000  # ids that are broadcast; more are joined by a shuffle


@dataclass(frozen=True)
class Threshold:
    """Links when `den` * intersection >= `num` * union."""

    size: int
    num: int
    den: int

    def prefix(self, n):
        return n + 1 - (self.num * n + self.den - 1) // self.den

    def overlap(self, total):
        """The least intersection of two sets with `total` shingles together."""
        return -(-self.num * total // (self.den + self.num))

    def apart(self, total):
        """The most differing shingles of two such sets."""
        return total - 2 * self.overlap(total)

    def splits(self, n: int) -> list[int]:
        """Logarithms of the numbers of parts in which a set of `n` is compared: that of its
        own size, and that of the smallest set it may link with where it differs. A pair meets
        in the parts of its smaller set."""
        return sorted({_log_parts(n), _log_parts(-(-self.num * n // self.den))})

    def heads(self, n: int, log: int) -> int:
        """How many first shingles of a part to post."""
        if log == 0:
            return self.prefix(n)
        return (self.apart(n + n * self.den // self.num) >> log) + 1


def _log_parts(n: int) -> int:
    return max(0, (n - 1).bit_length() - PART.bit_length() + 1)


def _texts(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text"))


def _sets(batch: pa.RecordBatch, size: int, key=None) -> Iterator[tuple[int, np.ndarray]]:
    """Row number and sorted distinct shingles of every text that has words.

    `key` maps shingle hashes one-to-one to the numbers they are sorted by.
    """
    data, offsets = words.buffers(batch.column("text"))
    for lo, hi in words.chunks(offsets):
        found, counts = words.shingle_sets(data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo], size)
        found = found if key is None else key(found)
        end = np.cumsum(counts)
        for row in np.flatnonzero(counts):
            own = np.sort(found[end[row] - counts[row] : end[row]])
            if len(own) > 1:
                own = own[np.append(True, own[1:] != own[:-1])]
            yield lo + int(row), own


def _signature(own: np.ndarray) -> bytes:
    one = words.mix(own).sum(dtype=np.uint64)
    two = words.mix(own ^ np.uint64(0xA5A5A5A55A5A5A5A)).sum(dtype=np.uint64)
    return np.array([one, two], np.uint64).tobytes()


def _cells(own: np.ndarray, log: int) -> bytes:
    """CELLS counts for each of 2 ** log parts, one byte each."""
    part = (own >> np.uint64(40)) & np.uint64((1 << log) - 1)
    at = (part * np.uint64(CELLS) + (own >> np.uint64(58))).astype(np.int64)
    return np.minimum(np.bincount(at, minlength=CELLS << log), 255).astype(np.uint8).tobytes()


def _profiler(limit: Threshold):
    def profile(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.zeros(BUCKETS, np.int64)
        for batch in batches:
            rows = batch.num_rows
            n, sig, hist = np.zeros(rows, np.int64), [None] * rows, [None] * rows
            for row, own in _sets(batch, limit.size):
                n[row], sig[row] = len(own), _signature(own)
                hist[row] = b"".join(_cells(own, log) for log in limit.splits(len(own)))
                np.add.at(seen, (own & np.uint64(BUCKETS - 1)).astype(np.int64), 1)
            none = pa.nulls(rows, pa.int32()), pa.nulls(rows, pa.int64())
            yield _profile_batch(batch.column("doc_id"), n, pa.array(sig, pa.binary()), pa.array(hist, pa.binary()), *none)
        full = np.flatnonzero(seen)
        if len(full):
            none = pa.nulls(len(full), pa.binary())
            yield _profile_batch(pa.nulls(len(full), pa.int64()), pa.nulls(len(full), pa.int64()), none, none, full.astype(np.int32), seen[full])

    return profile


def _profile_batch(*columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c) if isinstance(c, np.ndarray) else c for c in columns], ["doc_id", "n", "sig", "hist", "bucket", "seen"])


def _ranker(rank: np.ndarray):
    """Shingle hash to its number in the global order: its bucket's rank, then the other bits."""

    def key(found: np.ndarray) -> np.ndarray:
        bucket = rank[(found & np.uint64(BUCKETS - 1)).astype(np.int64)]
        return (bucket << np.uint64(48)) | (found >> np.uint64(16))

    return key


def _postings(limit: Threshold, rank: np.ndarray):
    def post(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, met = _ranker(rank), set()
        for batch in batches:
            ids = batch.column("doc_id").to_numpy(zero_copy_only=False)
            tokens, docs, sizes, spots = [], [], [], []
            for row, own in _sets(batch, limit.size, key):
                sig = _signature(own)
                if sig in met:  # one of the equal sets of a task stands for all of them
                    continue
                met.add(sig)
                cell, count = 0, 0
                for log in limit.splits(len(own)):
                    heads = limit.heads(len(own), log)
                    part = ((own >> np.uint64(24)) & np.uint64((1 << log) - 1)).astype(np.int64)
                    order = np.argsort(part, kind="stable")
                    part = part[order]
                    place = np.arange(len(own)) - np.searchsorted(part, part)
                    keep = place < heads
                    found = own[order[keep]]
                    tokens.append(words.mix(found + np.uint64(log)) if log else found)
                    spots.append(((cell + part[keep]) << 36) | (log << 30) | place[keep])
                    cell += 1 << log
                    count += len(found)
                docs.append(np.full(count, ids[row], np.int64))
                sizes.append(np.full(count, len(own), np.int32))
            if tokens:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(graph.as_i64(np.concatenate(tokens))), *[pa.array(np.concatenate(x)) for x in (docs, sizes, spots)]],
                    ["token", "doc_id", "n", "spot"],
                )

    return post


def _groups(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """Tables of whole groups from batches sorted by `keys`; many small groups come together."""
    rest = None
    for batch in batches:
        table = pa.Table.from_batches([batch]) if rest is None else pa.concat_tables([rest, pa.Table.from_batches([batch])])
        if not table.num_rows:
            continue
        same = np.ones(table.num_rows, bool)
        for name in keys:
            column = table.column(name).to_numpy()
            same &= column == column[-1]
        start = int(np.flatnonzero(~same)[-1]) + 1 if not same.all() else 0
        if start:
            yield table.slice(0, start).combine_chunks()
        rest = table.slice(start)
    if rest is not None and rest.num_rows:
        yield rest.combine_chunks()


def _candidates(limit: Threshold):
    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        met = graph.Forest()
        for table in _groups(batches, ["token", "lo", "hi"]):
            columns = [table.column(c).to_numpy() for c in ("token", "lo", "hi", "rep", "n", "spot")]
            order = np.lexsort((columns[3], columns[4], *columns[2::-1]))
            token, lo, hi, rep, n, spot = (x[order] for x in columns)
            log, place = spot >> 30 & 63, spot & ((1 << 30) - 1)
            cells = np.frombuffer(b"".join(table.column("hist").to_pylist()), np.uint8).reshape(-1, CELLS)[order].astype(np.int16)
            group = np.cumsum(np.append(False, (token[1:] != token[:-1]) | (lo[1:] != lo[:-1]) | (hi[1:] != hi[:-1])))
            live = np.arange(len(rep))
            step = 0
            while len(live):
                step += 1
                live = live[live + step < len(rep)]
                other = live + step
                # Sizes ascend inside a group, so a row that fails here fails for all later steps.
                keep = (group[live] == group[other]) & (n[live] * limit.den >= n[other] * limit.num)
                live, other = live[keep], other[keep]
                total = n[live].astype(np.int64) + n[other]
                left = np.minimum(n[live] - place[live], n[other] - place[other])
                ok = ((left >= limit.overlap(total)) | (log[live] > 0)) & (rep[live] != rep[other]) & (log[live] == log[other])
                a, b, most = live[ok], other[ok], limit.apart(total[ok]) >> log[live[ok]]
                for at in range(0, len(a), 1 << 16):
                    x, y = a[at : at + (1 << 16)], b[at : at + (1 << 16)]
                    near = np.abs(cells[x] - cells[y]).sum(1) <= most[at : at + (1 << 16)]
                    for p, q in zip(rep[x[near]].tolist(), rep[y[near]].tolist()):
                        met.join(p, q)
        yield from _edges(met.pairs())

    return compare


def _edges(pairs) -> Iterator[pa.RecordBatch]:
    rows = np.array(list(pairs), np.int64).reshape(-1, 2)
    yield pa.RecordBatch.from_arrays([pa.array(rows[:, 0]), pa.array(rows[:, 1])], ["a", "b"])


class _Node:
    """A compressed trie node: shingles that sets `lo` to `hi` go on with."""

    __slots__ = ("children", "depth", "hi", "last", "lo", "most", "segment")

    def __init__(self, lo: int, hi: int, depth: int, segment: np.ndarray, last: int, most: int) -> None:
        self.lo, self.hi, self.depth, self.segment, self.last, self.most = lo, hi, depth, segment, last, most
        self.children: list[_Node] = []


def _trie(sets: list[np.ndarray]) -> _Node:
    """The trie of sets in lexicographic order."""
    shared = np.zeros(len(sets) + 1, np.int64)
    for i in range(1, len(sets)):
        m = min(len(sets[i]), len(sets[i - 1]))
        differ = np.flatnonzero(sets[i][:m] != sets[i - 1][:m])
        shared[i] = differ[0] if len(differ) else m
    sizes = np.array([len(s) for s in sets])

    def node(lo: int, hi: int, above: int) -> _Node:
        depth = len(sets[lo]) if hi - lo == 1 else int(shared[lo + 1 : hi].min())
        last = int(sets[lo][depth - 1]) if depth else -1
        return _Node(lo, hi, depth, sets[lo][above:depth], last, int(sizes[lo:hi].max()))

    top = node(0, len(sets), 0)
    todo = [top]
    while todo:
        now = todo.pop()
        if now.hi - now.lo == 1:
            continue
        cuts = [now.lo, *(now.lo + 1 + np.flatnonzero(shared[now.lo + 1 : now.hi] == now.depth)).tolist(), now.hi]
        now.children = [node(a, b, now.depth) for a, b in zip(cuts, cuts[1:])]
        todo += now.children
    return top


def _upto(rows: np.ndarray, size: int) -> np.ndarray:
    """How many of `rows` are below 0, 1, ... `size`."""
    marks = np.zeros(size + 1, np.int64)
    marks[rows + 1] = 1
    return np.cumsum(marks)


def trie_links(stored: list[tuple], walking: list[tuple] | None, limit: Threshold, met: graph.Forest) -> None:
    """Joins in `met` the nodes whose sets link; items are (node, node it is joined with
    already, set). `walking` sets meet all `stored` ones, or these each other if it is None.

    Shingles are numbered by how many of the sets have them, so sets share long paths from
    the root. What no other set has is left out of the trie and counts as a difference.
    """
    items = stored + (walking or [])
    for node, home, _ in items:
        met.join(home, node)
    found, number, count = np.unique(np.concatenate([x[2] for x in items]), return_inverse=True, return_counts=True)
    place = np.empty(len(found), np.int64)
    place[np.argsort(-count, kind="stable")] = np.arange(len(found))
    common = int((count > 1).sum())
    cut = np.cumsum([len(x[2]) for x in items])[:-1]
    own = [np.sort(s[s < common]) for s in np.split(place[number], cut)]
    full = np.array([len(x[2]) for x in items])
    order = np.array(sorted(range(len(stored)), key=lambda i: own[i].astype(">u4").tobytes()))
    walkers = order if walking is None else np.arange(len(stored), len(items))
    # Differing cells are differing shingles, so they bound the overlap from above.
    cells = np.stack([np.bincount(s % WALK_CELLS, minlength=WALK_CELLS) for s in own]).astype(np.int32)
    alone = full - np.array([len(s) for s in own])
    sets, sizes, stored_cells, stored_alone = [own[i] for i in order], full[order], cells[order], alone[order]
    roots = np.array([met.root(items[i][0]) for i in order])
    top, mask = _trie(sets), np.zeros(common, bool)
    for step, i in enumerate(walkers):
        upto = step if walking is None else len(sets)
        n, walker, mine = int(full[i]), own[i], met.root(items[i][0])
        total = n + sizes[:upto]
        most_apart = total - 2 * limit.overlap(total)
        near = np.flatnonzero((roots[:upto] != mine) & (np.abs(total - 2 * n) <= most_apart) & (stored_alone[:upto] + alone[i] <= most_apart))
        if len(near):
            apart = np.abs(stored_cells[near] - cells[i]).sum(1) + stored_alone[near] + alone[i]
            near = near[apart <= most_apart[near]]
        if not len(near):
            continue
        open_ = _upto(near, len(sets))
        mask[walker] = True
        todo = [(top, 0)]
        while todo:
            at, overlap = todo.pop()
            if open_[at.hi] == open_[at.lo]:
                continue
            overlap += int(np.count_nonzero(mask[at.segment]))
            left = len(walker) - int(np.searchsorted(walker, at.last, "right"))
            if at.hi - at.lo > 1:
                if (overlap + min(left, at.most - at.depth)) * (limit.den + limit.num) >= limit.num * (n + int(sizes[at.lo : at.hi].min())):
                    todo += [(child, overlap) for child in at.children]
            elif limit.den * overlap >= limit.num * (n + int(sizes[at.lo]) - overlap):
                met.join(items[i][0], items[order[at.lo]][0])
                joined = (roots == mine) | (roots == roots[at.lo])
                mine = met.root(mine)
                roots[joined] = mine
                near = near[roots[near] != mine]
                open_ = _upto(near, len(sets))
        mask[walker] = False


def _verify(limit: Threshold):
    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        met = graph.Forest()
        for table in _groups(batches, ["component", "lo", "hi"]):
            keys = np.stack([table.column(c).to_numpy() for c in ("component", "lo", "hi")])
            cut = np.append(np.flatnonzero(np.append(True, (keys[:, 1:] != keys[:, :-1]).any(0))), table.num_rows)
            for a, b in zip(cut, cut[1:]):
                part = table.slice(a, b - a).combine_chunks()
                batch = part.to_batches(max_chunksize=part.num_rows)[0]
                rep, home, block = (batch.column(c).to_pylist() for c in ("rep", "home", "block"))
                by: dict = {}
                for row, own in _sets(batch, limit.size):
                    by.setdefault((block[row], rep[row]), (rep[row], home[row], own))
                low, high = batch.column("lo")[0].as_py(), batch.column("hi")[0].as_py()
                stored = [x for (k, _), x in by.items() if k == low]
                walking = [x for (k, _), x in by.items() if k != low] if low != high else None
                if stored and (len(stored) > 1 if walking is None else walking):
                    trie_links(stored, walking, limit, met)
        yield from _edges(met.pairs())

    return verify


def _blocks(members: DataFrame, weight: str, key: str, most: int, pairs: bool) -> DataFrame:
    """Adds `lo`, `hi`: every row's block of at most about `most` weight in its group, or
    with `pairs` a row for each block it has to meet. Groups of one block stay one row."""
    count = F.ceil(F.col(weight) / F.lit(most)).cast("int")
    own = F.pmod(F.xxhash64(key), F.greatest(count, F.lit(1))).cast("int")
    if not pairs:
        return members.withColumn("block", own).withColumn("lo", own).withColumn("hi", own).drop(weight)
    others = F.explode(F.sequence(F.lit(0), F.greatest(count, F.lit(1)) - 1))
    return (
        members.withColumn("block", own)
        .withColumn("_other", others)
        .withColumn("lo", F.least("block", "_other"))
        .withColumn("hi", F.greatest("block", "_other"))
        .drop("_other", weight)
    )


def _by_group(df: DataFrame, keys: list[str]) -> DataFrame:
    return df.repartition(*keys).sortWithinPartitions(*keys)


def _linked(docs: DataFrame, members: DataFrame, limit: Threshold) -> DataFrame:
    """Links found among `members` (rep, home, component, lo, hi) by tries of their whole sets."""
    texts = _texts(docs)
    slim = stage(members)
    listed = slim.select(F.col("rep").alias("doc_id")).distinct()
    if graph.small_enough(listed, BROADCAST_IDS):
        texts = texts.join(F.broadcast(listed), "doc_id", "left_semi")
    texts = texts.join(slim.withColumnRenamed("rep", "doc_id"), "doc_id").withColumnRenamed("doc_id", "rep")
    return _by_group(texts, ["component", "lo", "hi"]).mapInArrow(_verify(limit), "a long, b long")


def jaccard_groups(docs: DataFrame, size: int = 5, num: int = 80, den: int = 100, group_rows: int = GROUP_ROWS, block_shingles: int = BLOCK_SHINGLES) -> DataFrame:
    """`doc_id`, `n_shingles`, `component_id` of every row of `docs` (doc_id, text).

    Documents link when den * |A & B| >= num * |A | B| over their sets of `size`-word
    shingles; a component's id is the smallest doc_id that links lead to.
    """
    limit = Threshold(size, num, den)
    texts = _texts(docs)
    if texts.where("doc_id is not null").groupBy("doc_id").count().where("count > 1").isEmpty():
        return _text_groups(texts, limit, group_rows, block_shingles)
    # Every text of an id is a node of its own, linked with the id's least node.
    node = F.when(F.col("doc_id").isNotNull(), F.xxhash64("doc_id", F.coalesce("text", F.lit(b""))))
    numbered = texts.withColumn("_id", F.col("doc_id")).withColumn("doc_id", node)
    groups = stage(_text_groups(numbered.select("doc_id", "text"), limit, group_rows, block_shingles))
    ids = stage(numbered.where("doc_id is not null").select("_id", F.col("doc_id").alias("node")).distinct())
    same = ids.join(ids.groupBy("_id").agg(F.min("node").alias("b")), "_id").select(F.col("node").alias("a"), "b")
    linked = groups.where("doc_id is not null").select(F.col("doc_id").alias("a"), F.col("component_id").alias("b"))
    found = graph.components(same.union(linked).where("a <> b").distinct())
    placed = stage(ids.join(found, "node", "left").select("node", F.coalesce("component", "node").alias("component"), "_id"))
    least = placed.groupBy("component").agg(F.min("_id").alias("component_id"))
    named = placed.join(least, "component").select(F.col("node").alias("doc_id"), "_id", "component_id")
    return groups.drop("component_id").join(named, "doc_id", "left").select(F.col("_id").alias("doc_id"), "n_shingles", "component_id")


def _text_groups(texts: DataFrame, limit: Threshold, group_rows: int, block_shingles: int) -> DataFrame:
    """The groups of `texts` (doc_id, text) in which rows of one id have equal texts."""
    profiled = stage(texts.mapInArrow(_profiler(limit), "doc_id long, n long, sig binary, hist binary, bucket int, seen long"))
    slim = profiled.where("bucket is null").select("doc_id", "n", "sig", "hist")
    seen = np.zeros(BUCKETS, np.int64)
    for bucket, count in profiled.where("bucket is not null").groupBy("bucket").agg(F.sum("seen")).collect():
        seen[bucket] = count
    rank = np.empty(BUCKETS, np.uint64)
    rank[np.argsort(seen, kind="stable")] = np.arange(BUCKETS, dtype=np.uint64)

    linkable = slim.where("n > 0 and doc_id is not null")
    classes = linkable.groupBy("sig").agg(F.min("doc_id").alias("rep"))
    named = stage(linkable.join(classes, "sig").select("doc_id", "n", "hist", "rep"))
    postings = texts.where("doc_id is not null").mapInArrow(_postings(limit, rank), "token long, doc_id long, n int, spot long")
    shared = (
        postings.withColumn("_count", F.count(F.lit(1)).over(Window.partitionBy("token")))
        .where("_count > 1")
        .join(named.select("doc_id", "rep", "hist").dropDuplicates(["doc_id"]), "doc_id")
        .select("token", "rep", "n", "spot", F.substring("hist", F.shiftright("spot", 36).cast("int") * CELLS + 1, F.lit(CELLS)).alias("hist"), "_count")
    )
    met = _by_group(_blocks(shared, "_count", "rep", group_rows, pairs=True), ["token", "lo", "hi"]).mapInArrow(_candidates(limit), "a long, b long")
    coarse = graph.components(met)

    sizes = named.where("doc_id = rep").select("rep", "n").dropDuplicates(["rep"])
    members = stage(
        coarse.withColumnRenamed("node", "rep")
        .join(sizes, "rep")
        .select("rep", "n", "component", F.col("rep").alias("home"))
        .join(coarse.withColumnRenamed("node", "rep").join(sizes, "rep").groupBy("component").agg(F.sum("n").alias("_weight")), "component")
    )
    links = stage(_linked(texts, _blocks(members.drop("n"), "_weight", "rep", block_shingles, pairs=False), limit))
    links = _join_blocks(texts, members, links, limit, block_shingles)
    found = graph.components(links).select(F.col("node").alias("rep"), F.col("component").alias("component_id"))
    ids = named.select("doc_id", "rep").dropDuplicates(["doc_id"]).join(found, "rep", "left").select("doc_id", F.coalesce("component_id", "rep").alias("component_id"))
    return slim.join(ids, "doc_id", "left").select("doc_id", F.col("n").alias("n_shingles"), F.coalesce("component_id", "doc_id").alias("component_id"))


def _join_blocks(docs: DataFrame, members: DataFrame, links: DataFrame, limit: Threshold, block: int) -> DataFrame:
    """Adds the links between blocks of candidate groups that took more than one trie.

    First one set of every component found so far stands for it, which joins most blocks of
    a group of near copies. Groups that are still apart compare all pairs of their blocks,
    where sets of one component skip each other.
    """
    large = stage(members.where(F.col("_weight") > block))
    if large.isEmpty():
        return links
    for pairs in (False, True):
        found = graph.components(links).select(F.col("node").alias("rep"), F.col("component").alias("_found"))
        now = large.join(found, "rep", "left").withColumn("home", F.coalesce("_found", "rep")).drop("_found")
        apart = now.groupBy("component").agg(F.min("home").alias("_x"), F.max("home").alias("_y")).where("_x < _y").select("component")
        now = now.join(apart, "component", "left_semi")
        if pairs:  # in the blocks of before, which have met themselves
            split = _blocks(now.drop("n"), "_weight", "rep", block, pairs=True).where("lo < hi")
        else:
            now = stage(now.where("rep = home").drop("_weight"))
            weight = now.groupBy("component").agg(F.sum("n").alias("_weight"))
            split = _blocks(now.drop("n").join(weight, "component"), "_weight", "rep", block, pairs=False)
        links = stage(links.union(_linked(docs, split, limit)))
    return links


def one_of_each_group(docs: DataFrame, size: int = 5, num: int = 80, den: int = 100) -> DataFrame:
    """The rows of `docs` that no row of a smaller id, or equal row, links to; all columns stay.

    Of rows with one id a single one stays; rows with a null id all stay.
    """
    groups = jaccard_groups(docs, size, num, den)
    gone = stage(groups.where("doc_id <> component_id").select("doc_id").distinct())
    kept = docs.join(F.broadcast(gone) if graph.small_enough(gone, BROADCAST_IDS) else gone, "doc_id", "left_anti").select(*docs.columns)
    again = stage(groups.where("doc_id is not null").groupBy("doc_id").count().where("count > 1").select("doc_id"))
    if again.isEmpty():
        return kept
    listed = F.broadcast(again) if graph.small_enough(again, BROADCAST_IDS) else again
    return kept.join(listed, "doc_id", "left_anti").select(*docs.columns).unionByName(kept.join(listed, "doc_id", "left_semi").select(*docs.columns).dropDuplicates(["doc_id"]))

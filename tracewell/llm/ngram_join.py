"""Exact Jaccard self-join of word shingles by PartEnum signatures, and the components of its links.

A text's set holds its distinct n-word shingles as 64-bit hashes. Sets fall into size bands so narrow that linked sets
lie in the same or in neighbouring bands; an instance serves a band and the one below it, and there linked sets differ in
at most k shingles. An instance cuts the hash domain into groups of `parts` partitions each. As two differences in each
of more than k // 2 groups would exceed k, linked sets have a group in which at most one partition differs, so the
subsets of all but one partition of every group are enumerated, and the content of one such subset is equal in both: a
shared signature. More parts make signatures more selective, and more of them. An instance has `spare` groups more than
needed, so that a set may leave out the signatures of empty subsets as long as no more than `spare` groups have any;
otherwise it adds a round with another seed (in the last round empty subsets count too), which keeps the join exact and
empty subsets from pooling unrelated sets.

Equal sets are one node, a 62-bit fingerprint. A node is in two instances, as a vertex in each: the two low bits of a
vertex say which. Up to FEW vertices that share a signature are compared with each other by their parity sketches (two to
four bits a shingle, each the parity of the shingles that hash to it; two sets differ in at least as many shingles as
their sketches in bits), which drops most chance meetings and no link; more of them are tied to the smallest without a
test. This gives candidate components, a superset of the links' components. They are split in two passes of spanning(),
first by sketches, then by the sets themselves, for exact links. A pass cuts a component into chunks of bounded size, each
together with one leader of the whole component, and each chunk's task returns a spanning forest of its links: so a
component of copies is joined up by sending each member once. Only members that are then still apart from their
component's largest class are compared with all other chunks. No step expands the pairs of a group into rows or holds a
whole group in one task.

Defined results: null and empty texts have an empty set and link with nothing; texts with fewer than n words have their
whole sequence as one shingle; repeated rows are one component; rows with a null doc_id link others but give no component
its name (a component of such rows alone has null); extra columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import lru_cache
from itertools import combinations
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tracewell.llm.bpe_count import Memo
from tracewell.llm.common import mix64, stored, tables_of_worker
from tracewell.llm.components import connected_components, join_hot

KEPT_WORDS = 200_000
KEPT_PRINTS = 200_000
ROUNDS = 6
#: Bounds of a chunk: sets and shingles, of sets and of sketches.
SETS = 1024, 1_000_000
SKETCHES = 4096, 16_000_000
SENT_ROWS = 100_000
BITMAP_BITS = 1 << 23
FEW = 4
NO_ID = -(1 << 63)
#: The low bits of a vertex: which of a node's two instances it is in, by the parity of the instance; whether that one is of the next larger band.
ODD, BELOW = 1, 2


@tables_of_worker
def word_hashes() -> Memo:
    """Hashes by word, for all tasks of a worker."""
    return Memo(xxhash.xxh3_64_intdigest, KEPT_WORDS)


def shingles(text: str | None, n: int) -> np.ndarray:
    """The sorted hashes of a text's distinct n-word shingles; A-Z are lower-cased."""
    found = text.encode("utf-8", "surrogatepass").lower().split() if text else []
    h = np.fromiter(map(word_hashes().__getitem__, found), np.uint64, len(found))
    if not len(h):
        return h
    width = min(n, len(h))
    s = np.full(len(h) - width + 1, width, np.uint64)
    for i in range(width):
        s = s * np.uint64(0x9E3779B97F4A7C15) + h[i : len(h) - width + 1 + i]
    return np.unique(mix64(s))


def fingerprint(grams: np.ndarray) -> int:
    """The node of a set; its low bits are free for vertices."""
    return int(mix64(mix64(grams ^ np.uint64(0x5851F42D4C957F2D)).sum(keepdims=True) + np.uint64(len(grams)))[0].astype(np.int64)) & ~(ODD | BELOW)


def node_of(vertex: str) -> Column:
    return F.col(vertex).bitwiseAND(F.lit(~(ODD | BELOW)))


class Instance(NamedTuple):
    groups: int
    spare: int
    edges: np.ndarray  # where partitions end in the hash domain
    salts: list[np.ndarray]  # by round, a salt for each group and subset


def bands(percent: int) -> Iterator[tuple[int, int]]:
    low = 1
    while True:
        high = low * 100 // percent
        yield low, high
        low = high + 1


@lru_cache(maxsize=None)
def band_limits(percent: int, most: int) -> np.ndarray:
    """Largest sizes of the bands, up to the one that holds the size most and the one after."""
    found = []
    for _, high in bands(percent):
        found.append(high)
        if len(found) > 1 and found[-2] >= most:
            return np.array(found)


@lru_cache(maxsize=None)
def instance(percent: int, parts: int, j: int, low_below: int, high: int) -> Instance:
    """For sets of low_below to high shingles; j only salts."""
    k = (100 - percent) * 2 * high // (100 + percent)
    size = 0.7 * low_below + 0.3 * high
    needed = k // 2 + 1

    def cost(spare: int) -> float:  # signatures expected of a set of that size: those of one round, and of more
        groups = needed + spare
        rate = groups * parts * math.exp(size * math.log1p(-(parts - 1) / (parts * groups)))
        return groups * (1 + math.erfc((spare + 0.5 - rate) / math.sqrt(2 * rate + 1e-9)) / 2)

    spare = min(range(needed + 1), key=cost)
    groups = needed + spare
    if k == 0:  # only equal sets link: one partition, one subset
        groups, spare = 1, 0
    n = parts * groups
    edges = np.array([(i << 64) // n for i in range(1, n)], np.uint64)
    salts = [mix64(np.arange(n, dtype=np.uint64) + np.uint64((j << 40) + (r << 36))).reshape(groups, parts) for r in range(ROUNDS)]
    return Instance(groups, spare, edges, salts)


def signatures(grams: np.ndarray, percent: int, parts: int = 3) -> tuple[np.ndarray, np.ndarray]:
    """All signatures of a set, and the low bits of the vertex that each is of."""
    size, found, bits = len(grams), [], []
    limits = band_limits(percent, 1 << max(8, size.bit_length()))
    band = int(np.searchsorted(limits, size))
    for j in (band, band + 1):
        at = len(found)
        below = int(limits[j - 2]) + 1 if j >= 2 else 1
        it = instance(percent, parts, j, below, int(limits[j]))
        if it.groups == 1 and (100 - percent) * 2 * int(limits[j]) // (100 + percent) == 0:
            found.append(mix64(mix64(grams).sum(keepdims=True) + it.salts[0][0, :1]))
        else:
            for r in range(ROUNDS):
                h = grams if r == 0 else np.sort(mix64(grams ^ np.uint64(0xA0761D6478BD642F * r % (1 << 64))))
                ends = np.concatenate([[0], np.searchsorted(h, it.edges), [size]])
                total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mix64(h + np.uint64(r + 1)))])[ends]
                sums, counts = np.diff(total).reshape(it.groups, parts), np.diff(ends).reshape(it.groups, parts)
                subset = mix64(sums.sum(1, keepdims=True) - sums + it.salts[r])  # of the others
                filled = counts.sum(1, keepdims=True) - counts > 0
                last = r == ROUNDS - 1
                found.append(subset.ravel() if last else subset[filled])
                if (~filled.all(1)).sum() <= it.spare:
                    break
        bits.append(np.full(sum(map(len, found[at:])), j & ODD | (BELOW if j > band else 0), np.int64))
    return np.concatenate(found), np.concatenate(bits)


def unit_links(sides: list[int], classes: list[int], sets: list[np.ndarray], percent: int) -> list[tuple[int, int]]:
    """A spanning forest of the links among sets, each tree a star around its first; of different sides and classes if there are two sides."""
    m = len(sets)
    sizes = np.array([len(s) for s in sets])
    shared = np.zeros((m, m), np.float32)
    if m <= 6:
        for a, b in combinations(range(m), 2):
            shared[a, b] = shared[b, a] = len(np.intersect1d(sets[a], sets[b], assume_unique=True))
    else:
        values, owner = np.concatenate(sets), np.repeat(np.arange(m), sizes)
        order = np.argsort(values, kind="stable")
        values, owner = values[order], owner[order]
        starts = np.flatnonzero(np.concatenate([[True], values[1:] != values[:-1]]))
        often = np.diff(np.append(starts, len(values)))
        for d in range(2, 9):  # rare shingles: their few pairs
            at = starts[often == d]
            for i in range(0, len(at), 100_000):
                who = owner[at[i : i + 100_000, None] + np.arange(d)]
                for a, b in combinations(range(d), 2):
                    pairs = np.bincount(who[:, a] * m + who[:, b], minlength=m * m).reshape(m, m)
                    shared += pairs + pairs.T
        heavy = np.flatnonzero(often > 8)
        for i in range(0, len(heavy), 2048):  # frequent ones: products of 0-1 matrices
            part = heavy[i : i + 2048]
            table = np.zeros((m, len(part)), np.float32)
            for c, k in enumerate(part):
                table[owner[starts[k] : starts[k] + often[k]], c] = 1
            shared += table @ table.T
    linked = 100 * shared >= percent * (sizes[:, None] + sizes[None, :] - shared)
    allowed = apart(sides, classes)
    return forest(m, lambda a, left: left[linked[a, left] & allowed(a, left)])


def apart(sides: list[int], classes: list[int]):
    """Which of others a may be tied to: all, or, if there are two sides, those of the other side and of another class."""
    side, of = np.array(sides), np.array(classes)
    if not len(side) or side.min() == side.max():
        return lambda a, others: np.ones(len(others), bool)
    return lambda a, others: (side[others] != side[a]) & (of[others] != of[a])


def forest(m: int, neighbours) -> list[tuple[int, int]]:
    """Edges from the first of each tree to its others; neighbours(i, left) are those of left that i is tied to."""
    left, found = np.arange(m), []
    while len(left):
        a, left, todo = int(left[0]), left[1:], [left[0]]
        while todo and len(left):
            tied = neighbours(int(todo.pop()), left)
            if len(tied):
                left = np.setdiff1d(left, tied, assume_unique=True)
                found.extend((a, b) for b in tied.tolist())
                todo.extend(tied)
    return found


def sketch(grams: np.ndarray) -> bytes:
    """The parity of the shingles in each of its cells, of which there are a power of two, two to four for each shingle."""
    cells = 1 << max(8, (2 * len(grams) - 1).bit_length())
    at = (mix64(grams + np.uint64(0x632BE59BD9B4E019)) & np.uint64(cells - 1)).astype(np.int64)
    return np.packbits((np.bincount(at, minlength=cells) & 1).astype(np.uint8), bitorder="little").tobytes()


def folded(sketches: list[bytes], size: int) -> np.ndarray:
    """A row of words for each sketch, as if all had been made with the cells of one of `size` bytes."""
    rows = np.empty((len(sketches), size // 8), np.uint64)
    for i, s in enumerate(sketches):
        words = np.frombuffer(s, np.uint64)
        while len(words) > size // 8:
            words = words[: len(words) // 2] ^ words[len(words) // 2 :]
        rows[i] = words
    return rows


def unit_near(sides: list[int], classes: list[int], vertices: list[int], sizes: list[int], sketches: list[bytes], percent: int) -> list[tuple[int, int]]:
    """Like unit_links(), for what the sketches don't rule out; what is of the band below in this instance is left to another."""
    size, below = np.array(sizes, np.int64), np.array(vertices) & BELOW > 0
    words = folded(sketches, min(map(len, sketches)))
    allowed = apart(sides, classes)

    def near(a: int, left: np.ndarray) -> np.ndarray:
        some = left[allowed(a, left) & (100 * np.minimum(size[left], size[a]) >= percent * np.maximum(size[left], size[a])) & ~(below[left] & below[a])]
        differ = np.bitwise_count(words[some] ^ words[a]).sum(1, dtype=np.int64)
        return some[(100 + percent) * differ <= (100 - percent) * (size[some] + size[a])]

    return forest(len(sizes), near)


class Runs:
    """Turns rows sorted by signature and node into edges: all pairs of runs of up to FEW nodes (star: false), stars of longer ones."""

    def __init__(self):
        self.keys, self.nodes, self.long = np.zeros(0, np.int64), np.zeros(0, np.int64), None  # a run that may go on

    def add(self, keys: np.ndarray, nodes: np.ndarray) -> list[np.ndarray]:
        """Edges as rows of (u, v, star)."""
        keys, nodes, found = np.concatenate([self.keys, keys]), np.concatenate([self.nodes, nodes]), []
        if self.long is not None:
            sig, least = self.long
            same = len(keys) if (keys == sig).all() else int(np.argmax(keys != sig))
            found.append(self._star(nodes[:same], least))
            keys, nodes = keys[same:], nodes[same:]
        self.keys, self.nodes = keys[:0], nodes[:0]
        if len(keys):
            fresh = np.concatenate([[True], (keys[1:] != keys[:-1]) | (nodes[1:] != nodes[:-1])])
            keys, nodes = keys[fresh], nodes[fresh]
            last = int(np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))[-1])
            found += self._complete(keys[:last], nodes[:last])
            if len(keys) - last > FEW:
                self.long = keys[last], nodes[last]
                found.append(self._star(nodes[last:], nodes[last]))
            else:
                self.long, self.keys, self.nodes = None, keys[last:], nodes[last:]
        return found

    def end(self) -> list[np.ndarray]:
        return self._complete(self.keys, self.nodes)

    @staticmethod
    def _star(nodes: np.ndarray, least) -> np.ndarray:
        other = nodes[nodes != least]
        return np.stack([other, np.full(len(other), least, np.int64), np.ones(len(other), np.int64)], 1)

    def _complete(self, keys: np.ndarray, nodes: np.ndarray) -> list[np.ndarray]:
        if not len(keys):
            return []
        starts = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
        lengths, found = np.diff(np.append(starts, len(keys))), []
        for d in range(2, FEW + 1):
            at = starts[lengths == d]
            for a, b in combinations(range(d), 2):
                u, v = nodes[at + a], nodes[at + b]
                here = (u & v & BELOW) == 0
                found.append(np.stack([u[here], v[here], np.zeros(here.sum(), np.int64)], 1))
        for i in np.flatnonzero(lengths > FEW).tolist():
            run = nodes[starts[i] : starts[i] + lengths[i]]
            if (run & BELOW == 0).any():
                found.append(self._star(run, run[0]))
        return found


def slices(batch: pa.RecordBatch, rows: int = 500) -> Iterator[pa.RecordBatch]:
    for i in range(0, batch.num_rows, rows):
        yield batch.slice(i, rows)


def _grams(documents: DataFrame, n: int) -> DataFrame:
    """doc_id, size of the set, its fingerprint and sketch (null: empty set)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                sets = [shingles(t, n) for t in part.column(1).to_pylist()]
                yield pa.record_batch([part.column(0), pa.array([len(s) for s in sets], pa.int64()), pa.array([fingerprint(s) if len(s) else None for s in sets], pa.int64()), pa.array([sketch(s) if len(s) else None for s in sets], pa.binary())], ["doc_id", "n_shingles", "node", "sketch"])

    return documents.mapInArrow(run, "doc_id long, n_shingles long, node long, sketch binary")


def _candidates(documents: DataFrame, nodes: DataFrame, n: int, percent: int, parts: int) -> DataFrame:
    """Edges of vertices whose components hold all links: those that share a signature, less pairs whose sketches rule a link out."""

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()  # what this task has signed: copies add nothing
        keys, vertices = [], []

        def rows() -> Iterator[pa.RecordBatch]:
            found, of = np.concatenate(keys).view(np.int64), np.concatenate(vertices)
            keys.clear(), vertices.clear()
            for i in range(0, len(of), SENT_ROWS):
                yield pa.record_batch([pa.array(found[i : i + SENT_ROWS]), pa.array(of[i : i + SENT_ROWS])], ["sig", "vertex"])

        for batch in batches:
            for part in slices(batch):
                for text in part.column(1).to_pylist():
                    grams = shingles(text, n)
                    if not len(grams) or (node := fingerprint(grams)) in seen:
                        continue
                    if len(seen) >= KEPT_PRINTS:
                        seen.clear()
                    seen.add(node)
                    found, bits = signatures(grams, percent, parts)
                    keys.append(found)
                    vertices.append(node | bits)
                    if sum(map(len, keys)) >= SENT_ROWS:
                        yield from rows()
        if keys:
            yield from rows()

    def tie(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows(found: list[np.ndarray]) -> pa.RecordBatch:
            edges = np.unique(np.concatenate([np.zeros((0, 3), np.int64), *found]), axis=0)
            return pa.record_batch([pa.array(edges[:, 0].copy()), pa.array(edges[:, 1].copy()), pa.array(edges[:, 2] == 1)], ["u", "v", "star"])

        runs = Runs()
        for batch in batches:
            yield rows(runs.add(batch.column(0).to_numpy(), batch.column(1).to_numpy()))
        yield rows(runs.end())

    def near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, 2000):
                u, v, n_u, s_u, n_v, s_v = (part.column(k) for k in ("u", "v", "n_u", "s_u", "n_v", "s_v"))
                a, b = s_u.to_pylist(), s_v.to_pylist()
                least = np.array([min(len(x), len(y)) for x, y in zip(a, b, strict=True)])
                differ = np.zeros(len(least), np.int64)
                for size in np.unique(least).tolist():
                    at = np.flatnonzero(least == size)
                    differ[at] = np.bitwise_count(folded([a[i] for i in at], size) ^ folded([b[i] for i in at], size)).sum(1, dtype=np.int64)
                close = (100 + percent) * differ <= (100 - percent) * (n_u.to_numpy() + n_v.to_numpy())
                yield pa.record_batch([u, v], ["u", "v"]).filter(pa.array(close))

    signed = documents.mapInArrow(sign, "sig long, vertex long")
    edges = stored(signed.repartition("sig").sortWithinPartitions("sig", "vertex").mapInArrow(tie, "u long, v long, star boolean").distinct(), "met", release=True)
    side = lambda k: nodes.select(F.col("node").alias(f"node_{k}"), F.col("n_shingles").alias(f"n_{k}"), F.col("sketch").alias(f"s_{k}"))
    pairs = edges.where("not star").select("u", "v", node_of("u").alias("node_u"), node_of("v").alias("node_v"))
    pairs = pairs.join(side("u"), "node_u").join(side("v"), "node_v").select("u", "v", "n_u", "s_u", "n_v", "s_v")
    return edges.where("star").select("u", "v").unionByName(pairs.mapInArrow(near, "u long, v long"))


def _bit(doc_id: Column) -> Column:
    return F.pmod(F.xxhash64(doc_id), F.lit(BITMAP_BITS)).cast("int")


def _bitmap(ids: DataFrame) -> Broadcast:
    """Marks the bits of the column doc_id, so that most other documents are known not to be among them: 1 MB at any size."""
    words = ids.select(_bit(F.col("doc_id")).alias("bit")).groupBy(F.expr("bit div 32").alias("word")).agg(F.bit_or(F.expr("shiftleft(1, bit % 32)")).alias("mask")).toArrow()
    bitmap = np.zeros(BITMAP_BITS // 32, np.uint32)
    bitmap[words.column("word").to_numpy()] = words.column("mask").to_numpy().view(np.uint32)
    return ids.sparkSession.sparkContext.broadcast(bitmap)


def _sets(documents: DataFrame, members: DataFrame, n: int) -> DataFrame:
    """node and its set (payload), for the nodes of members (node, doc_id), from the texts of their doc_ids."""
    sent = _bitmap(members)

    def fetch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        marked = sent.value
        for batch in batches:
            bits = batch.column(2).to_numpy()
            hit = np.flatnonzero(marked[bits >> 5] >> (bits & 31).astype(np.uint32) & 1)
            for part in slices(batch.take(pa.array(hit))):
                sets = [shingles(t, n) for t in part.column(1).to_pylist()]
                full = pa.array([len(s) > 0 for s in sets], pa.bool_())
                yield pa.record_batch([part.column(0), pa.array([fingerprint(s) if len(s) else None for s in sets], pa.int64()), pa.array([s.tobytes() for s in sets], pa.binary())], ["doc_id", "node", "payload"]).filter(full)

    return documents.select("doc_id", "text", _bit(F.col("doc_id")).alias("bit")).mapInArrow(fetch, "doc_id long, node long, payload binary")


def _forests(units: DataFrame, edges) -> DataFrame:
    """Runs edges(sides, classes, vertices, sizes, payloads) on each unit, a chunk against a part; u and v are the vertices of its edges."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, held = None, {}

        def done() -> pa.RecordBatch:
            nodes = sorted(held)
            vertices = [v for v, _ in nodes]
            if len(nodes) > 1:
                classes, sizes, payloads = zip(*(held[x] for x in nodes), strict=True)
                pairs = edges([side for _, side in nodes], classes, vertices, sizes, payloads)
            else:
                pairs = []
            return pa.record_batch([pa.array([vertices[a] for a, _ in pairs], pa.int64()), pa.array([vertices[b] for _, b in pairs], pa.int64())], ["u", "v"])

        for batch in batches:
            for piece in slices(batch):
                for root, chunk, part, side, vertex, of, size, payload in zip(*(piece.column(i).to_pylist() for i in range(8)), strict=True):
                    if (root, chunk, part) != key:
                        if held:
                            yield done()
                        key, held = (root, chunk, part), {}
                    held[vertex, side] = of, size, payload
        if held:
            yield done()

    rows = units.select("root", "chunk", "part", "side", "vertex", "class", "n_shingles", "payload")
    return rows.repartition("root", "chunk", "part").sortWithinPartitions("root", "chunk", "part").mapInArrow(run, "u long, v long")


def spanning(members: DataFrame, with_payload, edges, most: tuple[int, int]) -> DataFrame:
    """Edges that span the links among members (vertex, root, n_shingles, ...) of one root.

    most: sets and shingles of a chunk. with_payload(rows) adds the column payload to rows of members; edges as in
    _forests(). First each chunk is joined up in itself and with a leader of its root; then what is apart from its root's
    largest class meets all chunks, in parts of bounded size.
    """
    pieces = F.greatest(F.ceil(F.count("*") / most[0]), F.ceil(F.sum("n_shingles") / most[1])).cast("int")
    roots = stored(members.groupBy("root").agg(F.count("*").alias("n"), pieces.alias("n_chunks"), F.min("vertex").alias("leader")), "roots")
    placed = join_hot(members, roots, "root").withColumn("chunk", F.pmod(F.xxhash64("vertex"), F.col("n_chunks")).cast("int"))
    placed = stored(placed.drop("n"), "placed")
    everywhere = F.when(F.col("vertex") == F.col("leader"), F.sequence(F.lit(0), F.col("n_chunks") - 1)).otherwise(F.array("chunk"))
    first = placed.withColumn("chunk", F.explode(everywhere)).withColumn("part", F.lit(0)).withColumn("side", F.lit(0)).withColumn("class", F.lit(0).cast("long"))
    found = stored(_forests(with_payload(first), edges), "within", release=True)

    large = placed.where("n_chunks > 1")
    if large.isEmpty():
        return found
    classes = connected_components(found.join(large.select(F.col("vertex").alias("u")), "u", "left_semi")).withColumnRenamed("root", "class").withColumnRenamed("node", "vertex")
    large = stored(large.join(classes, "vertex", "left").withColumn("class", F.coalesce("class", "vertex")), "classes")
    main = large.groupBy("root", "class").agg(F.count("*").alias("n")).groupBy("root").agg(F.max(F.struct("n", "class"))["class"].alias("main"), F.sum("n").alias("n"))
    rest = join_hot(large, stored(main, "main"), "root").where("class != main").drop("n", "main")
    parts = stored(rest.groupBy("root").agg(F.count("*").alias("n_rest"), pieces.alias("n_parts")), "parts")
    if parts.isEmpty():
        return found
    counted = roots.join(parts, "root")
    part = F.pmod(F.xxhash64("vertex", F.lit(1)), F.col("n_parts")).cast("int")
    out = join_hot(rest.drop("n_chunks", "leader"), counted, "root").withColumn("part", part).withColumn("chunk", F.explode(F.sequence(F.lit(0), F.col("n_chunks") - 1))).withColumn("side", F.lit(1))
    home = join_hot(large.drop("n_chunks", "leader"), counted, "root").withColumn("part", F.explode(F.sequence(F.lit(0), F.col("n_parts") - 1))).withColumn("side", F.lit(0))
    columns = [*members.columns, "chunk", "part", "side", "class"]
    across = _forests(with_payload(out.select(columns).unionByName(home.select(columns))), edges)
    return found.unionByName(stored(across, "across", release=True))


def jaccard_components(documents: DataFrame, n: int, percent: int, parts: int = 3) -> DataFrame:
    """doc_id, n_shingles and component_id of every row; sets link when 100 * intersection >= percent * union."""
    rows, named = _named(documents, n, percent, parts)
    own = F.when(F.col("doc_id") != NO_ID, F.col("doc_id"))
    full = rows.where("node is not null").join(named, "node").select(own.alias("doc_id"), "n_shingles", "component_id")
    return full.unionByName(rows.where("node is null").select(own.alias("doc_id"), "n_shingles", own.alias("component_id")))


def _named(documents: DataFrame, n: int, percent: int, parts: int) -> tuple[DataFrame, DataFrame]:
    """Each row's doc_id (NO_ID: none), n_shingles and node; each node's root, component_id and the smallest node that has a row with that id."""
    texts = documents.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("doc_id"), "text")
    rows = stored(_grams(texts, n), "sets")
    nodes = stored(rows.where("node is not null").groupBy("node").agg(F.min("doc_id").alias("any_id"), F.min(F.when(F.col("doc_id") != NO_ID, F.col("doc_id"))).alias("doc_id"), F.max("n_shingles").alias("n_shingles"), F.max("sketch").alias("sketch")), "nodes", release=True)
    candidates = connected_components(_candidates(texts, nodes, n, percent, parts)).withColumnRenamed("node", "vertex")
    known = nodes.select("node", "n_shingles", F.col("any_id").alias("doc_id"))
    sized = lambda found: stored(found.withColumn("node", node_of("vertex")).join(known, "node").select("vertex", "root", "node", "doc_id", "n_shingles"), "members")
    near = lambda sides, classes, vertices, sizes, payloads: unit_near(sides, classes, vertices, sizes, payloads, percent)
    sketches = lambda placed: placed.join(nodes.select("node", F.col("sketch").alias("payload")), "node")
    candidates = connected_components(spanning(sized(candidates), sketches, near, SKETCHES)).withColumnRenamed("node", "vertex")
    links = lambda sides, classes, _, __, payloads: unit_links(sides, classes, [np.frombuffer(p, np.uint64) for p in payloads], percent)
    sets = lambda placed: placed.join(_sets(texts, placed, n), ["doc_id", "node"])
    exact = spanning(sized(candidates), sets, links, SETS)
    found = connected_components(exact.select(node_of("u").alias("u"), node_of("v").alias("v")))
    named = nodes.join(found, "node", "left").select("node", "doc_id", F.coalesce("root", "node").alias("root"))
    names = stored(named.groupBy("root").agg(F.count("*").alias("n"), F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "node")).alias("first")), "names")
    named = join_hot(named, names, "root").select("node", "root", F.col("first.doc_id").alias("component_id"), F.col("first.node").alias("first_node"))
    return rows, stored(named, "named", release=True)


def one_of_each(documents: DataFrame, n: int = 5, percent: int = 80, parts: int = 3) -> DataFrame:
    """One row of documents for each component, and all rows with an empty set, with all their columns.

    It is a row with the component's smallest doc_id; of several with that id, the one of smallest fingerprint, and any
    of equal texts. Ids need not be unique: rows are told apart by id and text. Null ids come last.
    """
    rows, named = _named(documents, n, percent, parts)
    whole = rows.where("node is not null").groupBy("doc_id", "node").agg(F.count("*").alias("n")).join(named, "node")
    stays = (F.coalesce("component_id", F.lit(NO_ID)) == F.col("doc_id")) & (F.col("first_node") == F.col("node"))
    verdicts = stored(whole.select("doc_id", "node", "n", stays.alias("stays")).where("not stays or n > 1"), "copies", release=True)
    sent = _bitmap(verdicts)
    table = documents.select(F.struct(*(documents[c] for c in documents.columns)).alias("_row"), F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("_id"), F.col("text").alias("_text"))
    table = table.withColumn("_bit", _bit(F.col("_id")))

    def clear(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        marked = sent.value
        for batch in batches:
            bits = batch.column(1).to_numpy()
            yield pa.record_batch([batch.column(0)], ["_row"]).filter(pa.array((marked[bits >> 5] >> (bits & 31).astype(np.uint32) & 1) == 0))

    def asked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        marked = sent.value
        for batch in batches:
            bits = batch.column(3).to_numpy()
            for part in slices(batch.take(pa.array(np.flatnonzero(marked[bits >> 5] >> (bits & 31).astype(np.uint32) & 1)))):
                sets = [shingles(t, n) for t in part.column(2).to_pylist()]
                nodes = pa.array([fingerprint(s) if len(s) else None for s in sets], pa.int64())
                yield pa.record_batch([part.column(0), part.column(1), nodes], ["_row", "_id", "_node"])

    row = table.select("_row")
    surely = table.select("_row", "_bit").mapInArrow(clear, row.schema)
    marked = table.mapInArrow(asked, table.select("_row", "_id", F.lit(0).cast("long").alias("_node")).schema)
    # only rows that the bitmap marks are shuffled; the others surely stay
    judged = marked.join(verdicts, (F.col("_id") == verdicts["doc_id"]) & (F.col("_node") == verdicts["node"]), "left")
    single = judged.where("stays is null").select("_row")
    repeated = judged.where("stays").dropDuplicates(["_id", "_node"]).select("_row")
    return surely.unionByName(single).unionByName(repeated).select("_row.*")

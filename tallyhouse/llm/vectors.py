"""Near duplicates among embeddings by navigable small-world graphs, one for each shard.

Equal vectors of a label are one class. The classes of a label are dealt to shards of
bounded size; each shard's hierarchical graph is built once and stored. Blocks of
classes then query every shard of their label: a beam descends the layers, widens at
the bottom one, and spreads over its links, in either direction, for as long as it finds
links. An audit compares some of the block's queries with brute force over the shard;
while it misses links the beam is doubled, and beyond the shard's size brute force takes the block.
Every reported link is verified by cosine in double precision.

Vectors that are null, empty or zero, or hold null or non-finite components, and rows
without a label link with nothing. Rows that repeat are one class. Vectors of other
length are never compared. An empty table gives an empty result; other columns do not
take part. Classes are told apart by 64-bit hashes.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyhouse.llm.common import batches_of, packed, quoted, ship, stored, unpacked
from tallyhouse.llm.graph import components, forest

#: Classes of a shard, and of a block of queries.
SHARD_ROWS, BLOCK_ROWS = 8192, 512

#: Neighbours kept at a node, beam of construction, first beam of a query.
NEIGHBOURS, BUILD_BEAM, QUERY_BEAM = 16, 48, 64

#: One query in so many is audited, and the mean recall of a query that an audit asks for,
#: so that a query with one link weighs as much as one with thousands.
AUDIT_EVERY, AUDIT_RECALL = 8, 0.999


class Layer:
    """One graph of the hierarchy over the first ``size`` vectors of a shard."""

    def __init__(self, size: int) -> None:
        self.near = np.full((size, 2 * NEIGHBOURS), -1, np.int32)

    @functools.cached_property
    def back(self) -> tuple[np.ndarray, np.ndarray]:
        """The links the other way: nodes that link to a node, and where each node's begin."""
        source, slot = np.nonzero(self.near >= 0)
        target = self.near[source, slot]
        order = np.argsort(target, kind="stable")
        return source[order], np.searchsorted(target[order], np.arange(len(self.near) + 1))

    def beside(self, nodes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(place in ``nodes``, node linked with it in either direction)."""
        place, slot = np.nonzero(self.near[nodes] >= 0)
        sources, begin = self.back
        count = begin[nodes + 1] - begin[nodes]
        behind = np.arange(count.sum()) + np.repeat(begin[nodes] - np.cumsum(count) + count, count)
        return (np.concatenate([place, np.repeat(np.arange(len(nodes)), count)]),
                np.concatenate([self.near[nodes[place], slot], sources[behind]]))

    def search(self, vectors: np.ndarray, queries: np.ndarray, entry: np.ndarray, beam: int,
               spread: float | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(ids, cosines, seen) of the ``beam`` best nodes found for each query, all queries in
        step. With ``spread`` nodes of that cosine are expanded even outside the beam."""
        rows = np.arange(len(queries))
        seen = np.zeros((len(queries), len(self.near)), bool)
        seen[rows, entry] = True
        ids = np.full((len(queries), beam), -1, np.int64)
        scores = np.full((len(queries), beam), -2.0)
        ids[:, 0], scores[:, 0] = entry, np.einsum("ij,ij->i", queries, vectors[entry])
        done = np.ones((len(queries), beam), bool)
        done[:, 0] = False
        while len(active := np.flatnonzero(~done.all(1))):
            pick = np.where(done[active], -3.0, scores[active]).argmax(1)
            done[active, pick] = True
            found = self.near[ids[active, pick]]
            new = (found >= 0) & ~seen[active[:, None], found]
            q, k = np.nonzero(new)
            if not len(q):
                continue
            node, query = found[q, k], active[q]
            seen[query, node] = True
            fresh = np.full(found.shape, -2.0)
            fresh[q, k] = np.einsum("ij,ij->i", queries[query], vectors[node])
            all_ids = np.concatenate([ids[active], np.where(fresh > -2, found, -1)], 1)
            all_scores = np.concatenate([scores[active], fresh], 1)
            all_done = np.concatenate([done[active], fresh == -2], 1)
            best = np.argpartition(-all_scores, beam - 1, 1)[:, :beam]
            for kept, every in ((ids, all_ids), (scores, all_scores), (done, all_done)):
                kept[active] = np.take_along_axis(every, best, 1)
        if spread is not None:
            self._spread(vectors, queries, ids, scores, seen, spread)
        return ids, scores, seen

    def _spread(self, vectors, queries, ids, scores, seen, least: float) -> None:
        """Follow the links of every node of cosine ``least``, in either direction, to all such
        nodes they lead to. A node among many near copies keeps links to a few of them, and
        may be kept by none; the links backwards find it."""
        query, slot = np.nonzero(scores >= least)
        node = ids[query, slot]
        while len(query):
            place, found = self.beside(node)
            reached = query[place]
            new = ~seen[reached, found]
            pairs = np.unique(reached[new].astype(np.int64) * len(self.near) + found[new])
            query, node = pairs // len(self.near), pairs % len(self.near)
            seen[query, node] = True
            good = np.einsum("ij,ij->i", queries[query], vectors[node]) >= least
            query, node = query[good], node[good]


def chosen(vectors: np.ndarray, centres: np.ndarray, candidates: np.ndarray, scores: np.ndarray, most: int) -> np.ndarray:
    """Neighbours for each centre: from the best candidates on, those nearer to the centre
    than to any neighbour taken before; then the best of the others, up to ``most``."""
    order = np.argsort(-scores, 1, kind="stable")
    candidates, scores = np.take_along_axis(candidates, order, 1), np.take_along_axis(scores, order, 1)
    own = vectors[np.maximum(candidates, 0)]
    between = np.einsum("ijk,ilk->ijl", own, own)
    taken = np.zeros(candidates.shape, bool)
    for place in range(candidates.shape[1]):
        hidden = (taken & (between[:, place] > scores[:, place, None])).any(1)
        taken[:, place] = (candidates[:, place] >= 0) & ~hidden & (taken.sum(1) < most)
    rank = np.where(taken, 0, np.where(candidates >= 0, 1, 2)) * candidates.shape[1] + np.arange(candidates.shape[1])
    best = np.argsort(rank, 1)[:, :most]
    return np.where(np.take_along_axis(candidates, best, 1) >= 0, np.take_along_axis(candidates, best, 1), -1)


class Graph:
    """A hierarchical navigable small-world graph over unit vectors (double precision)."""

    def __init__(self, vectors: np.ndarray, layers: list[Layer]) -> None:
        self.vectors, self.layers = vectors, layers

    @classmethod
    def build(cls, vectors: np.ndarray) -> Graph:
        """Vectors must come in random order: the first of them make the upper layers."""
        sizes = [len(vectors)]
        while sizes[-1] > NEIGHBOURS * 2:
            sizes.append(sizes[-1] // NEIGHBOURS)
        graph = cls(vectors, [])
        for size in reversed(sizes):
            layer = Layer(size)
            at = 1
            while at < size:
                stop = min(size, at + min(max(at, 16), 512))
                graph._insert(layer, at, stop)
                at = stop
            graph.layers.insert(0, layer)
        return graph

    def _entry(self, queries: np.ndarray) -> np.ndarray:
        entry = np.zeros(len(queries), np.int64)
        for layer in reversed(self.layers[1:]):
            ids, scores, _ = layer.search(self.vectors, queries, entry, 4)
            entry = ids[np.arange(len(queries)), scores.argmax(1)]
        return entry

    def _insert(self, layer: Layer, at: int, stop: int) -> None:
        new = np.arange(at, stop)
        queries = self.vectors[at:stop]
        entry = np.zeros(len(new), np.int64)
        for above in reversed(self.layers):
            if len(above.near) <= at:
                ids, scores, _ = above.search(self.vectors, queries, entry, 4)
                entry = ids[np.arange(len(new)), scores.argmax(1)]
        ids, scores, _ = layer.search(self.vectors, queries, entry, BUILD_BEAM)
        mutual = queries @ queries.T
        np.fill_diagonal(mutual, -2.0)
        count = min(NEIGHBOURS, len(new))
        best = np.argpartition(-mutual, count - 1, 1)[:, :count]
        beside = np.take_along_axis(mutual, best, 1)
        ids = np.concatenate([ids, np.where(beside > -2, new[best], -1)], 1)
        scores = np.concatenate([scores, beside], 1)
        links = chosen(self.vectors, new, ids, scores, NEIGHBOURS)
        layer.near[at:stop, :NEIGHBOURS] = links[:, :NEIGHBOURS] if links.shape[1] >= NEIGHBOURS else np.pad(
            links, ((0, 0), (0, NEIGHBOURS - links.shape[1])), constant_values=-1)
        source, slot = np.nonzero(links >= 0)
        target, source = links[source, slot], new[source]
        order = np.argsort(target, kind="stable")
        target, source = target[order], source[order]
        heads = np.flatnonzero(np.diff(target, prepend=-1))
        place = np.arange(len(target)) - np.repeat(heads, np.diff(heads, append=len(target)))
        width = 2 * NEIGHBOURS
        for part in range(0, int(place.max(initial=-1)) + 1, width):
            now = (place >= part) & (place < part + width)
            nodes, row = np.unique(target[now], return_inverse=True)
            room = np.full((len(nodes), 2 * width), -1, np.int64)
            room[:, :width] = layer.near[nodes]
            room[row, width + place[now] - part] = source[now]
            near = np.einsum("ijk,ik->ij", self.vectors[np.maximum(room, 0)], self.vectors[nodes])
            layer.near[nodes] = chosen(self.vectors, nodes, room, np.where(room >= 0, near, -2.0), width)

    def links(self, queries: np.ndarray, least: float) -> tuple[np.ndarray, np.ndarray]:
        """(query, node) pairs of cosine ``least`` or more, audited."""
        beam, n = min(QUERY_BEAM, len(self.vectors)), len(self.vectors)
        audited = np.arange(0, len(queries), AUDIT_EVERY)
        truth = queries[audited] @ self.vectors.T >= least
        while beam < n:
            _, _, seen = self.layers[0].search(self.vectors, queries, self._entry(queries), beam, spread=least)
            found = (seen[audited] & truth).sum(1) / np.maximum(truth.sum(1), 1)
            if found[truth.any(1)].sum() >= AUDIT_RECALL * truth.any(1).sum():
                query, node = np.nonzero(seen)
                good = np.zeros(len(query), bool)
                for at in range(0, len(query), 1 << 17):
                    part = slice(at, at + (1 << 17))
                    good[part] = np.einsum("ij,ij->i", queries[query[part]], self.vectors[node[part]]) >= least
                return query[good], node[good]
            beam *= 2
        return np.nonzero(queries @ self.vectors.T >= least)

    def pack(self) -> bytes:
        return packed(np.array([self.vectors.shape[1], len(self.layers)], np.int64), self.vectors.ravel(),
                      *(layer.near.ravel() for layer in self.layers))

    @classmethod
    def unpack(cls, arrays: list[np.ndarray]) -> Graph:
        (width, count), flat, *near = arrays
        layers = []
        for values in near[:int(count)]:
            layer = Layer(0)
            layer.near = values.reshape(-1, 2 * NEIGHBOURS)
            layers.append(layer)
        return cls(flat.reshape(-1, int(width)), layers)


def unit_vector(values: list | None) -> np.ndarray | None:
    """The vector scaled to length 1, or None if it can link with nothing."""
    if not values or any(x is None for x in values):
        return None
    vector = np.array(values, np.float64)
    if not np.isfinite(vector).all() or not (top := np.abs(vector).max()):
        return None
    vector = vector / top
    return vector / np.sqrt(vector @ vector)


_ROWS = pa.schema([("id", pa.int64()), ("label", pa.string()), ("class", pa.int64()), ("vector", pa.binary())])


def linked(table: DataFrame, least: float = 0.93, id_col: str = "vec_id", vector_col: str = "embedding",
           label_col: str = "label") -> DataFrame:
    """(vec_id, n_links, component_id, kept), one row per vector."""
    spark = table.sparkSession
    ship(spark)
    raw = table.select(F.col(quoted(id_col)).cast("long").alias("id"), F.col(quoted(label_col)).cast("string").alias("label"),
                       F.col(quoted(vector_col)).cast("array<double>").alias("vector"))

    def name(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out() -> Iterator[tuple]:
            for batch in batches:
                for row_id, label, values in zip(*(batch.column(c).to_pylist() for c in ("id", "label", "vector")), strict=True):
                    vector = None if label is None else unit_vector(values)
                    body = None if vector is None else np.array(values, np.float64).tobytes()
                    key = None if body is None else xxhash.xxh3_64_intdigest(label.encode() + body, len(body))
                    yield row_id, label, key and int(np.uint64(key).view(np.int64)), None if body is None else vector.tobytes()
        yield from batches_of(out(), _ROWS)

    rows = stored(raw.mapInArrow(name, "id long, label string, class long, vector binary"), "vectors")
    own = rows.filter("class is not null")
    classes = own.groupBy("label", F.octet_length("vector").alias("width"), "class").agg(
        F.count("*").alias("copies"), F.first("vector").alias("vector"))
    sizes = classes.groupBy("label", "width").agg(F.count("*").alias("n"))
    dealt = stored(classes.join(sizes, ["label", "width"]).select(
        "label", "width", "class", "copies", "vector",
        F.pmod(F.xxhash64("class", F.lit(1)), F.ceil(F.col("n") / SHARD_ROWS)).alias("shard"),
        F.pmod(F.xxhash64("class", F.lit(2)), F.ceil(F.col("n") / BLOCK_ROWS)).alias("block")), "vector-classes")

    def matrix(group: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        order = np.argsort(group["class"].to_numpy(), kind="stable")  # hashes: a random order, the same each time
        bodies = group["vector"].to_pylist()
        vectors = np.frombuffer(b"".join(bodies[i] for i in order.tolist()), np.float64).reshape(len(order), -1)
        return group["class"].to_numpy()[order], group["copies"].to_numpy()[order], vectors

    def index(group: pa.Table) -> pa.Table:
        names, copies, vectors = matrix(group)
        return pa.table({"label": group["label"][:1], "width": group["width"][:1],
                         "graph": pa.array([packed(names, copies, Graph.build(vectors).pack())], pa.binary())})

    def gather(group: pa.Table) -> pa.Table:
        names, _, vectors = matrix(group)
        return pa.table({"label": group["label"][:1], "width": group["width"][:1],
                         "queries": pa.array([packed(names, vectors.ravel())], pa.binary())})

    graphs = stored(dealt.groupBy("label", "width", "shard").applyInArrow(index, "label string, width int, graph binary"), "vector-graphs")
    blocks = dealt.groupBy("label", "width", "block").applyInArrow(gather, "label string, width int, queries binary")
    found = pa.schema([("class", pa.int64()), ("n", pa.int64()), ("root", pa.int64())])

    def query(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block, shard in zip(batch.column("queries").to_pylist(), batch.column("graph").to_pylist(), strict=True):
                names, flat = unpacked(block)
                others, copies, body = unpacked(shard)
                graph = Graph.unpack(unpacked(body))
                q, node = graph.links(flat.reshape(len(names), -1), least)
                apart = names[q] != others[node]
                q, node = q[apart], node[apart]
                number = np.bincount(q, copies[node], len(names)).astype(np.int64)
                roots = forest(zip(names[q].tolist(), others[node].tolist(), strict=True))
                linked_to = [(n, int(c), roots.pop(n, n)) for n, c in zip(names.tolist(), number.tolist(), strict=True) if c]
                linked_to += [(n, 0, root) for n, root in roots.items()]
                if linked_to:
                    yield pa.record_batch([pa.array(c, f.type) for c, f in zip(zip(*linked_to, strict=True), found, strict=True)], schema=found)

    # Every block of a label meets each of the label's graphs: a query set against all rows, in blocks.
    links = stored(blocks.join(graphs, ["label", "width"]).repartition("queries").select("queries", "graph")
                   .mapInArrow(query, "class long, n long, root long"), "vector-links")
    counts = links.groupBy("class").agg(F.sum("n").alias("n"))
    roots = components(links.select(F.col("class").alias("a"), F.col("root").alias("b")))
    placed = (rows.join(dealt.select("class", "copies"), "class", "left").join(counts, "class", "left")
              .join(roots.select(F.col("node").alias("class"), "root"), "class", "left")
              .withColumn("root", F.coalesce("root", "class")))
    tops = placed.filter("root is not null").groupBy("root").agg(F.min("id").alias("top"))
    component = F.when(F.col("class").isNull(), F.col("id")).otherwise(F.col("top"))
    return placed.join(tops, "root", "left").select(
        F.col("id").alias("vec_id"), (F.coalesce("n", F.lit(0)) + F.coalesce(F.col("copies") - 1, F.lit(0))).alias("n_links"),
        component.alias("component_id"), F.col("id").eqNullSafe(component).alias("kept"))

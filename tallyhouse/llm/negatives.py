"""Hard negatives among embeddings, by cover trees over norm-augmented vectors.

Vectors become integers, floor(256 x). A candidate x of a shard gets one more component,
sqrt(M^2 - |x|^2) for the shard's greatest norm M, so that all candidates lie on one sphere
and the inner product with a query (whose extra component is 0) falls with the angle
between the two. The rows of each label in a shard form a cover tree: the children of a
node are centers taken farthest first until they cover its members at half its radius, or
until there are FAN of them, and every node knows how far its members reach. Radius and
angle bound the inner products of a node's members above and below: a node below a query's
window, or below the last of its best so far, is skipped, and so is a node above the
window. Each query goes to its most promising leaf first, then to the leaves that are
left, best first; the members of a leaf are scored exactly in integers. The search is
exact, so nothing is missed.

Shards hold SHARD_ROWS rows on average, a label of any size is spread over as many as it
needs and small labels share one. A shard's trees are built once, stored, and meet the
blocks of queries one after the other in one task; only the queries travel to each shard.

Rows with a null label, a null vector, or a null or non-finite component take no part, nor
do rows with a component of 2^26 or more, whose scores would not fit. A null id takes part
as a candidate, comes after the others among equal scores, and is no anchor. Vectors of
different length never meet. Rows are told apart by a number of their own, so an id that
repeats is another row; among equal scores and ids any row may come first, and the result
is the same. Empty vectors score 0. An empty table gives an empty result; other columns do
not take part.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyhouse.llm.common import packed, quoted, ship, shuffle_partitions, stored, unpacked

#: Rows of a shard and anchors of a block, on average.
SHARD_ROWS, BLOCK_ROWS = 8192, 2048

#: Members up to which a node is a leaf, and most children of a node.
LEAF_ROWS, FAN = 128, 32

#: Most (query, node) pairs whose bounds are held at once.
BOUND_PAIRS = 1 << 20

#: Components from here on would give scores beyond 63 bits.
TOO_LARGE = 1 << 26

#: What a null id counts as among equal scores.
LAST_ID = (1 << 63) - 1


def _exact(one: np.ndarray, other: np.ndarray) -> np.ndarray:
    """Integer inner products of all rows of two integer matrices."""
    top = float(np.abs(one).max(initial=0)) * float(np.abs(other).max(initial=0)) * one.shape[1]
    if top < 1 << 53:  # every sum is a whole number that doubles hold
        return (one.astype(np.float64) @ other.T.astype(np.float64)).astype(np.int64)
    return one.astype(np.int64) @ other.T.astype(np.int64)


class Cover:
    """The cover trees of a shard's labels: nodes level by level, members in order of the leaves."""

    def __init__(self, vectors, ids, rows, norm, label, center, radius, first, count, start, stop, roots) -> None:
        self.vectors, self.ids, self.rows, self.norm = vectors, ids, rows, norm
        self.label, self.center, self.radius = label, center, radius
        self.first, self.count, self.start, self.stop, self.roots = first, count, start, stop, roots

    @classmethod
    def build(cls, vectors: np.ndarray, ids: np.ndarray, rows: np.ndarray, labels: np.ndarray) -> Cover:
        squares = (vectors.astype(np.float64) ** 2).sum(1)
        norm = float(np.sqrt(squares.max(initial=0)))
        points = np.column_stack([vectors.astype(np.float64), np.sqrt(np.maximum(norm * norm - squares, 0))])
        names = np.unique(labels)
        level = [(int(name), own, own[0]) for name in names for own in [np.flatnonzero(labels == name)]]
        node_label, center, radius, first, count, start, stop, order = [], [], [], [], [], [], [], []
        size = 0
        while level:
            below, at = [], len(center) + len(level)
            for name, members, middle in level:
                far = np.sqrt(((points[members] - points[middle]) ** 2).sum(1))
                reach = float(far.max())
                node_label.append(name)
                center.append(middle)
                radius.append(reach)
                children = [] if len(members) <= LEAF_ROWS or not reach else cls._covered(points, members, middle, far)
                first.append(at + len(below))
                count.append(len(children))
                start.append(size)
                if children:
                    below += [(name, own, c) for own, c in children]
                else:
                    order.append(members)
                    size += len(members)
                stop.append(size if not children else start[-1])
            level = below
        order = np.concatenate(order)
        integers = [np.array(x, np.int64) for x in (node_label, first, count, start, stop)]
        return cls(vectors[order], ids[order], rows[order], norm, integers[0], vectors[np.array(center)],
                   np.array(radius), *integers[1:], len(names))

    @staticmethod
    def _covered(points: np.ndarray, members: np.ndarray, middle: int, far: np.ndarray) -> list[tuple[np.ndarray, int]]:
        nearest, owner, centers, reach = far.copy(), np.zeros(len(members), np.int64), [middle], far.max()
        own = points[members]
        while len(centers) < FAN:
            at = int(nearest.argmax())
            if nearest[at] <= reach / 2:
                break
            away = np.sqrt(((own - own[at]) ** 2).sum(1))
            closer = away < nearest
            nearest[closer], owner[closer] = away[closer], len(centers)
            centers.append(members[at])
        return [(members[owner == i], c) for i, c in enumerate(centers) if (owner == i).any()]

    def search(self, vectors: np.ndarray, labels: np.ndarray, of: np.ndarray, low: np.ndarray, high: np.ndarray,
               most: int, same: bool, own_rows: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(query, member, score): the first ``most`` members of every query's window.

        Query i has the vector and label of row ``of[i]`` and takes scores from low[i] to
        high[i], of members with the same label or of those with another one, but not
        its own row. Equal scores come in order of the ids.
        """
        n = len(of)
        length = np.sqrt((vectors.astype(np.float64) ** 2).sum(1))
        leaves, upper = self._leaves(vectors, length, labels, of, low, high, same)
        best = np.full((n, most), np.iinfo(np.int64).min)
        floor = low.copy()
        hits: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []

        def verify(leaf: int, queries: np.ndarray) -> None:
            members = slice(int(self.start[leaf]), int(self.stop[leaf]))
            needed, row = np.unique(of[queries], return_inverse=True)
            scores = _exact(vectors[needed], self.vectors[members])[row]
            fits = (scores >= floor[queries, None]) & (scores <= high[queries, None])
            if same:
                fits &= self.rows[members][None, :] != own_rows[of[queries], None]
            q, m = np.nonzero(fits)
            if not len(q):
                return
            score, q = scores[q, m], queries[q]
            hits.append((q, m + members.start, score))
            order = np.lexsort((-score, q))
            q, score = q[order], score[order]
            heads = np.flatnonzero(np.diff(q, prepend=-1))
            rank = np.arange(len(q)) - np.repeat(heads, np.diff(heads, append=len(q)))
            top, group = rank < most, np.repeat(np.arange(len(heads)), np.diff(heads, append=len(q)))
            touched = q[heads]
            new = np.full((len(touched), most), np.iinfo(np.int64).min)
            new[group[top], rank[top]] = score[top]
            best[touched] = np.sort(np.concatenate([best[touched], new], 1), 1)[:, most:]
            floor[touched] = np.maximum(floor[touched], best[touched, 0])

        if len(leaves):
            favourite, some = upper.argmax(1), np.isfinite(upper.max(1))
            for place in np.unique(favourite[some]).tolist():
                queries = np.flatnonzero(some & (favourite == place))
                verify(int(leaves[place]), queries)
                upper[queries, place] = -np.inf
            for place in np.argsort(-upper.max(0), kind="stable").tolist():
                queries = np.flatnonzero((upper[:, place] >= floor) & np.isfinite(upper[:, place]))
                if len(queries):
                    verify(int(leaves[place]), queries)
        if not hits:
            return tuple(np.empty(0, np.int64) for _ in range(3))
        q, m, score = (np.concatenate(x) for x in zip(*hits, strict=True))
        order = np.lexsort((self.rows[m], self.ids[m], -score, q))
        q, m, score = q[order], m[order], score[order]
        heads = np.flatnonzero(np.diff(q, prepend=-1))
        first = np.arange(len(q)) - np.repeat(heads, np.diff(heads, append=len(q))) < most
        return q[first], m[first], score[first]

    def _leaves(self, vectors, length, labels, of, low, high, same) -> tuple[np.ndarray, np.ndarray]:
        """Leaves that some query's window may reach, and the bound above of each (query, leaf), -inf where skipped."""
        nodes = np.arange(self.roots)
        active = (labels[of][:, None] == self.label[nodes][None, :]) == same
        leaves, bounds = [], []
        scale = (length * self.norm)[:, None]
        slack = 1 + 1e-9 * scale
        while len(nodes):
            used = active.any(0)
            nodes, active = nodes[used], active[:, used]
            if not len(nodes):
                break
            inner = vectors.astype(np.float64) @ self.center[nodes].T.astype(np.float64)
            angle = np.arccos(np.clip(np.divide(inner, scale, out=np.zeros_like(inner), where=scale > 0), -1, 1))
            reach = 2 * np.arcsin(np.clip(self.radius[nodes] / (2 * self.norm), 0, 1)) if self.norm else np.zeros(len(nodes))
            above = (scale * np.cos(np.maximum(angle - reach, 0)) + slack)[of]
            below = (scale * np.cos(np.minimum(angle + reach, np.pi)) - slack)[of]
            active &= (above >= low[:, None]) & (below <= high[:, None])
            leaf = self.count[nodes] == 0
            leaves.append(nodes[leaf])
            bounds.append(np.where(active[:, leaf], above[:, leaf], -np.inf))
            nodes, active = nodes[~leaf], active[:, ~leaf]
            count = self.count[nodes]
            inside = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
            active, nodes = np.repeat(active, count, 1), np.repeat(self.first[nodes], count) + inside
        return (np.concatenate(leaves), np.concatenate(bounds, 1)) if leaves else (np.empty(0, np.int64), np.empty((len(of), 0)))

    def pack(self) -> bytes:
        return packed(np.array([self.vectors.shape[1], self.roots], np.int64), np.array([self.norm]), _narrow(self.vectors),
                      self.ids, self.rows, self.label, _narrow(self.center), self.radius, self.first, self.count, self.start, self.stop)

    @classmethod
    def unpack(cls, value: bytes) -> Cover:
        (width, roots), (norm,), vectors, ids, rows, label, center, radius, first, count, start, stop = unpacked(value)
        return cls(vectors.reshape(len(ids), int(width)), ids, rows, float(norm), label, center.reshape(len(label), int(width)),
                   radius, first, count, start, stop, int(roots))


def _narrow(values: np.ndarray) -> np.ndarray:
    """Integers in two bytes each if all of them fit, else in four, in one row."""
    small = not values.size or (values.max() < 1 << 15 and values.min() >= -(1 << 15))
    return values.astype(np.int16 if small else np.int32).ravel()


def whole(values: Column) -> Column:
    """The vector in integers; null if it is null, or has a component that is null, not finite or too large."""
    scaled = F.transform(values, lambda x: F.floor(x * F.lit(256.0)))
    fits = F.forall(values, lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) * F.lit(256.0) < F.lit(float(TOO_LARGE))), F.lit(False)))
    return F.when(fits, scaled)


_FOUND = pa.schema([("anchor", pa.int64()), ("slot", pa.int32()), ("id", pa.int64()), ("row", pa.int64()), ("score", pa.int64())])
_FOUND_SQL = "anchor long, slot int, id long, row long, score long"


def _matrix(lists: pa.ChunkedArray, rows: int) -> np.ndarray:
    flat = lists.combine_chunks().flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(rows, -1) if rows else flat.reshape(0, 0)


def _built(group: pa.Table) -> pa.Table:
    ids = group["id"].fill_null(LAST_ID).to_numpy()
    tree = Cover.build(_matrix(group["vector"], len(ids)), ids, group["row"].to_numpy(), group["label"].to_numpy())
    return pa.table({"width": group["width"][:1], "shard": group["shard"][:1], "payload": pa.array([tree.pack()], pa.binary())})


def _block(group: pa.Table) -> pa.Table:
    """Queries of a block as one value; the rows of an anchor differ by slot and window only."""
    group = group.sort_by([("row", "ascending"), ("slot", "ascending")])
    rows, first, of = np.unique(group["row"].to_numpy(), return_index=True, return_inverse=True)
    vectors = _matrix(group["vector"], group.num_rows)[first]
    value = packed(np.array([vectors.shape[1]], np.int64), rows, group["label"].to_numpy()[first], _narrow(vectors),
                   of.astype(np.int64), *(group[n].to_numpy().astype(np.int64) for n in ("slot", "low", "high")))
    return pa.table({"width": group["width"][:1], "payload": pa.array([value], pa.binary())})


def _searched(most: int, same: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tree = None
        for batch in batches:
            for kind, payload in zip(batch.column("kind").to_pylist(), batch.column("payload").to_pylist(), strict=True):
                if kind == 0:  # sorted: a shard's trees come before its blocks
                    tree = Cover.unpack(payload)
                    continue
                (width,), rows, labels, vectors, of, slot, low, high = unpacked(payload)
                q, m, score = tree.search(vectors.reshape(len(rows), int(width)), labels, of, low, high, most, same, rows)
                ids = tree.ids[m]
                yield pa.record_batch([pa.array(rows[of[q]]), pa.array(slot[q].astype(np.int32)),
                                       pa.array(ids, mask=ids == LAST_ID), pa.array(tree.rows[m]), pa.array(score)], schema=_FOUND)
    return run


def mined(table: DataFrame, is_anchor: Column, label: Column, positives: int = 5, negatives: int = 3, least: int = 50,
          greatest: int = 95, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    For every anchor (``is_anchor`` of the table's columns) and each of its first
    ``positives`` rows of its ``label``, the first ``negatives`` rows of other labels whose
    score is from ``least`` to ``greatest`` hundredths of the positive's.
    """
    spark = table.sparkSession
    ship(spark)
    parts = shuffle_partitions(spark)
    values = F.col(quoted(vector_col)).cast("array<double>")
    rows = stored(table.select(F.col(quoted(id_col)).cast("long").alias("id"), label.cast("long").alias("label"),
                               F.coalesce(is_anchor, F.lit(False)).alias("is_anchor"), whole(values).alias("vector"))
                  .filter("label is not null and vector is not null")
                  .select("*", F.size("vector").alias("width"), F.monotonically_increasing_id().alias("row")), "negative-rows")
    sizes = rows.groupBy("width", "label").agg(F.count("*").alias("n"))
    small = sizes.filter(F.col("n") <= SHARD_ROWS).groupBy("width").agg(F.sum("n").alias("small"))
    spread = F.pmod(F.xxhash64("row"), F.ceil(F.col("n") / SHARD_ROWS))
    # Large labels have shards of their own; the small ones of a width share theirs, a label each whole.
    shard = F.when(F.col("n") > SHARD_ROWS, F.concat_ws(":", F.lit("label"), "label", spread)).otherwise(
        F.concat_ws(":", F.lit("shared"), F.pmod(F.xxhash64("label"), F.ceil(F.col("small") / SHARD_ROWS))))
    dealt = rows.join(sizes.join(small, "width", "left"), ["width", "label"]).withColumn("shard", shard)
    trees = stored(dealt.select("id", "label", "vector", "width", "row", "shard").groupBy("width", "shard")
                   .applyInArrow(_built, "width int, shard string, payload binary"), "negative-trees")
    anchors = rows.filter("is_anchor and id is not null").drop("is_anchor")
    number = max(1, -(-anchors.count() // BLOCK_ROWS))
    block = F.pmod(F.xxhash64("row"), F.lit(number)).alias("block")

    def found(blocks: DataFrame, most: int, same: bool) -> DataFrame:
        sides = trees.select("width", "shard", F.lit(0).alias("kind"), "payload").unionByName(
            blocks.select("width", "shard", F.lit(1).alias("kind"), "payload"))
        met = sides.repartition(parts, "width", "shard").sortWithinPartitions("width", "shard", "kind")
        answers = met.mapInArrow(_searched(most, same), _FOUND_SQL)
        best = Window.partitionBy("anchor", "slot").orderBy(F.desc("score"), F.col("id").asc_nulls_last(), "row")
        return answers.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= most)

    low, high = F.lit(-(1 << 62)), F.lit(1 << 62)
    homes = dealt.select("width", "label", "shard").distinct()
    near = (anchors.join(homes, ["width", "label"])
            .select("width", "shard", block, "label", "row", "vector", F.lit(0).alias("slot"), low.alias("low"), high.alias("high"))
            .groupBy("width", "shard", "block").applyInArrow(
                lambda group: _block(group).append_column("shard", group["shard"][:1]), "width int, payload binary, shard string"))
    positive = stored(found(near, positives, True).select(
        F.col("anchor").alias("row"), F.col("rank").alias("slot"), F.col("id").alias("positive_id"),
        F.col("score").alias("positive_score")), "negative-positives")
    score = F.col("positive_score").cast("decimal(20,0)")
    windows = (anchors.join(positive.filter(score >= 0), "row")
               .select("width", block, "label", "row", "vector", "slot", F.ceil(score * F.lit(least) / 100).cast("long").alias("low"),
                       F.floor(score * F.lit(greatest) / 100).cast("long").alias("high")))
    blocks = windows.groupBy("width", "block").applyInArrow(_block, "width int, payload binary")
    # The anchors in blocks against every shard of their width.
    far = blocks.join(trees.select("width", "shard"), "width")
    negative = found(far, negatives, False).select(F.col("anchor").alias("row"), "slot", "rank", F.col("id").alias("negative_id"),
                                                   F.col("score").alias("negative_score"))
    return (negative.join(positive, ["row", "slot"]).join(anchors.select("row", F.col("id").alias("anchor_id")), "row")
            .select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"))

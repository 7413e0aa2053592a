"""Embedding links and components against brute force."""

import numpy as np
import pytest

from tallyhouse.llm import vectors
from tallyhouse.llm.graph import components


def test_components_over_many_tasks(spark):
    draw = np.random.default_rng(2)
    links = [(int(a), int(b)) for a, b in draw.integers(0, 400, (300, 2))] + [(i, i + 1) for i in range(1000, 1100)]
    root = {}

    def find(x):
        root.setdefault(x, x)
        while root[x] != x:
            x = root[x]
        return x
    for a, b in links:
        x, y = find(a), find(b)
        root[max(x, y)] = min(x, y)
    frame = spark.createDataFrame(links, "a long, b long")
    for task_links in (1_000_000, 40):
        assert {r["node"]: r["root"] for r in components(frame, task_links).collect()} == {x: find(x) for x in root}
    assert components(frame.limit(0)).count() == 0


def table(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int, id string").repartition(3)


def test_links_are_brute_force(spark):
    draw = np.random.default_rng(4)
    centres = draw.normal(size=(30, 16))
    found = [c + draw.normal(size=16) * 0.12 for c in centres for _ in range(8)] + [centres[0]] * 5 + list(draw.normal(size=(200, 16)))
    labels = [int(x) for x in draw.integers(0, 3, len(found))]
    rows = [(i, [float(x) for x in np.float32(v)], y, "x") for i, (v, y) in enumerate(zip(found, labels, strict=True))]
    odd = [(900, None, 1, "x"), (901, [0.0] * 16, 1, "x"), (902, [float("nan")] * 16, 1, "x"), (903, [None] * 16, 1, "x"),
           (904, rows[0][1], None, "x"), (905, [], 0, "x"), (906, [1.0, 2.0], 0, "x")]
    result = {r["vec_id"]: tuple(r)[1:] for r in vectors.linked(table(spark, rows + odd)).collect()}
    unit = np.array([r[1] for r in rows], float)
    unit /= np.linalg.norm(unit, axis=1)[:, None]
    near = (unit @ unit.T >= 0.93) & (np.array(labels)[:, None] == np.array(labels))
    np.fill_diagonal(near, False)
    least = np.arange(len(rows))
    while (new := np.minimum(least, np.where(near, least, len(rows)).min(1))).tolist() != least.tolist():
        least = new
    for i in range(len(rows)):
        assert result[i] == (near[i].sum(), least[i], least[i] == i)
    assert all(result[i] == (0, i, True) for i in range(900, 907))
    assert near.sum() > 100
    assert vectors.linked(table(spark, rows[:1]).limit(0)).count() == 0


@pytest.mark.parametrize("hot", [0, 900])
def test_graph_finds_what_brute_force_finds(hot):
    draw = np.random.default_rng(1)
    points = draw.normal(size=(2000, 32))
    if hot:
        points[-hot:] = points[0] + draw.normal(size=(hot, 32)) * 0.1
    points[draw.permutation(1000)[:400]] += 0
    points /= np.linalg.norm(points, axis=1)[:, None]
    points = points[draw.permutation(len(points))]
    graph = vectors.Graph.unpack(vectors.unpacked(vectors.Graph.build(points).pack()))
    truth = points @ points.T >= 0.6
    q, node = graph.links(points, 0.6)
    assert truth[q, node].all() and len(q) >= 0.99 * truth.sum()


def test_hot_group_is_found_by_the_first_beam(monkeypatch):
    """A sixth of the rows in one group of near copies, which keep links to few of their like."""
    rng = np.random.default_rng(5)
    rows = rng.normal(size=(1800, 32))
    rows[:300] = rows[0] + 0.02 * rng.normal(size=(300, 32))
    rows[300:400] = rows[400:500] + 0.05 * rng.normal(size=(100, 32))
    rows = rng.permutation(rows / np.linalg.norm(rows, axis=1, keepdims=True))
    graph = vectors.Graph.build(rows)
    beams, search = [], vectors.Layer.search

    def watched(layer, *args, **options):
        if "spread" in options:
            beams.append(args[3])
        return search(layer, *args, **options)

    monkeypatch.setattr(vectors.Layer, "search", watched)
    truth = rows @ rows.T >= 0.93
    found = np.zeros(truth.shape, bool)
    for first in range(0, 1800, 600):
        query, node = graph.links(rows[first:first + 600], 0.93)
        found[first + query, node] = True
    assert beams == [vectors.QUERY_BEAM] * 3
    assert not (found & ~truth).any()
    assert ((found & truth).sum(1) / truth.sum(1)).mean() >= 0.999


def test_audit_weighs_queries_alike(monkeypatch):
    """One audited query that misses its only link widens the beam, whatever a hot group finds."""
    rng = np.random.default_rng(6)
    rows = rng.normal(size=(1200, 32))
    rows[:600] = rows[0] + 0.02 * rng.normal(size=(600, 32))
    rows[601] = rows[600]
    rows /= np.linalg.norm(rows, axis=1, keepdims=True)
    graph = vectors.Graph.build(rows)
    beams, search = [], vectors.Layer.search

    def blind(layer, *args, **options):
        ids, scores, seen = search(layer, *args, **options)
        if "spread" in options:
            beams.append(args[3])
            if len(beams) == 1:
                seen[-1, 601] = False
        return ids, scores, seen

    monkeypatch.setattr(vectors.Layer, "search", blind)
    monkeypatch.setattr(vectors, "AUDIT_EVERY", 1)
    graph.links(rows[np.r_[:100, 600]], 0.93)
    assert beams[:2] == [vectors.QUERY_BEAM, 2 * vectors.QUERY_BEAM]

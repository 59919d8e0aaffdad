"""Near vectors against all pairs: exact within cells, measured recall between them."""

import math

import numpy as np
import pytest

from telemill.llm import multi_index as M

VECTORS = "vec_id bigint, embedding array<double>, label int, row string, cell string, ball string"


def by_force(rows, limit=0.9):
    """n_links and component per place, in double precision."""
    dim = max([len(x) for _, x in rows if x] or [1])
    able = [
        x is not None and all(e is not None and math.isfinite(e) for e in x) and any(x)
        for _, x in rows
    ]
    units = np.zeros((len(rows), dim))
    for i, (_, x) in enumerate(rows):
        if able[i]:
            whole = np.array(x + [0.0] * (dim - len(x)))
            units[i] = whole / np.abs(whole).max()
            units[i] /= np.linalg.norm(units[i])
    linked = units @ units.T >= limit
    np.fill_diagonal(linked, False)
    part = list(range(len(rows)))
    for i in range(len(rows)):  # the smallest place that links reach
        todo, seen = [i], {i}
        while todo:
            for j in np.flatnonzero(linked[todo.pop()]):
                if j not in seen:
                    seen.add(int(j))
                    todo.append(int(j))
        known = [rows[j][0] for j in seen if rows[j][0] is not None]
        part[i] = min(known, default=None)
    return sorted(
        ((rows[i][0], int(linked[i].sum()), part[i], rows[i][0] == part[i]) for i in range(len(rows))), key=str
    )


def found(spark, rows):
    frame = spark.createDataFrame([(i, x, 1, "a", "b", "c") for i, x in rows], VECTORS)
    return sorted((tuple(row) for row in M.near_vectors(frame.repartition(3)).collect()), key=str)


def group(rng, n, dim, angle, centre=None):
    """Vectors up to an angle (degrees) from a centre."""
    centre = rng.normal(size=dim) if centre is None else centre
    centre = centre / np.linalg.norm(centre)
    ways = rng.normal(size=(n, dim))
    ways -= (ways @ centre)[:, None] * centre
    ways /= np.linalg.norm(ways, axis=1, keepdims=True)
    turn = np.radians(angle) * rng.random(n) ** 0.3
    return (np.cos(turn)[:, None] * centre + np.sin(turn)[:, None] * ways) * rng.uniform(0.1, 50, (n, 1))


def planted(rng, dim=16):
    centre = rng.normal(size=dim)
    return np.concatenate([
        group(rng, 150, dim, 8, centre),  # a ball
        group(rng, 60, dim, 24, centre),  # in doubt about it
        group(rng, 80, dim, 17),  # linked across balls
        *[group(rng, 6, dim, 20) for _ in range(10)],
        rng.normal(size=(120, dim)),
    ])


def numbered(vectors, rng):
    ids = rng.permutation(10 * len(vectors))[: len(vectors)]
    return [(int(i), x.tolist()) for i, x in zip(ids, vectors)]


@pytest.mark.parametrize("block, visitors", [(2048, 10_000), (16, 20)])
def test_within_a_cell_nothing_is_missed(spark, monkeypatch, block, visitors):
    """One cell, in one block and in many parts with several slots."""
    monkeypatch.setattr(M, "BLOCK", block)
    monkeypatch.setattr(M, "VISITORS", visitors)
    monkeypatch.setattr(M, "PER_CELL", 10**6)
    rng = np.random.default_rng(1)
    rows = numbered(planted(rng), rng)
    assert found(spark, rows) == by_force(rows)


def test_recall_between_cells(spark, monkeypatch):
    """Neighbours from the limit on, over some hundred cells: nothing false, and 90 % found."""
    monkeypatch.setattr(M, "BLOCK", 64)
    monkeypatch.setattr(M, "PER_CELL", 8)
    rng = np.random.default_rng(2)
    base = rng.normal(size=(500, 16))
    near = [group(rng, 1, 16, 25.8, x) for x in base]
    rows = numbered(np.concatenate([base, *near, planted(rng)]), rng)
    true, got = by_force(rows), found(spark, rows)
    assert [row[0] for row in true] == [row[0] for row in got]
    assert all(g[1] <= t[1] for g, t in zip(got, true))
    assert sum(g[1] for g in got) >= 0.9 * sum(t[1] for t in true)


def test_a_third_in_one_group(spark, monkeypatch):
    """Copies and near copies of one vector in many blocks: few rows stand for all of their pairs."""
    monkeypatch.setattr(M, "BLOCK", 32)
    rng = np.random.default_rng(3)
    same = np.repeat(rng.normal(size=(1, 8)), 300, axis=0)
    rows = numbered(np.concatenate([same, group(rng, 300, 8, 8), rng.normal(size=(600, 8))]), rng)
    true, got = by_force(rows), found(spark, rows)
    hot = {row[0]: row for row in got}
    for i, links, part, kept in true:
        if links >= 250:
            assert hot[i] == (i, links, part, kept)


def test_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (1, [1.0, 0.0]), (2, [1.0, 0.0]), (2, [1.0, 0.0]), (3, None), (4, []), (5, [0.0, 0.0]),
        (6, [nan, 1.0]), (7, [inf, 0.0]), (8, [None, 1.0]), (9, [1e-300, 0.0]), (10, [1e300, 1e299]),
        (11, [1.0]), (12, [0.0, 0.0, 5.0]), (13, [0.0, 0.0, 1.0, 0.0]), (None, [0.0, 1.0]), (None, [0.0, 2.0]),
        (None, None), (14, [-1.0, 0.0]), (15, [0.9, math.sqrt(0.19)]),
    ]
    assert found(spark, rows) == by_force(rows)


@pytest.mark.parametrize("rows", [[], [(1, None)], [(1, [0.0])], [(1, [2.0]), (2, [3.0])], [(5, [1.0, 2.0])]])
def test_few_vectors(spark, rows):
    assert found(spark, rows) == by_force(rows)


def test_reach_finds_the_target_share():
    rng = np.random.default_rng(4)
    sample = M.units(rng.normal(size=(4000, 32)))
    index = M.fit(sample, 20_000)
    fresh = M.units(rng.normal(size=(1000, 32)))
    near = M.units(np.concatenate([group(rng, 1, 32, 1e-9, x) for x in fresh]) * 1.0)
    ways = rng.normal(size=fresh.shape)
    ways -= (ways * fresh).sum(1, keepdims=True) * fresh
    near = M.units(0.9 * fresh + math.sqrt(0.19) * M.units(ways))
    at, cells = index.visited(fresh)
    met = set(zip(at.tolist(), cells.tolist()))
    assert np.mean([(i, c) in met for i, c in enumerate(index.own(near).tolist())]) >= 0.95
    assert len(cells) < 0.5 * index.cells * len(fresh)
    assert {(i, c) for i, c in enumerate(index.own(fresh).tolist())} <= met

"""Nearest rows against brute force, over data that are hard for the bounds."""

import numpy as np
import pytest

from siftmill.llm import neighbours
from siftmill.llm.neighbours import Codes, Grid, block_search, nearest_pairs

SCHEMA = "vec_no long, id string, usrcat array<float>, usrcat_valid boolean, number string, x string, copies int, cell int"


def table(spark, vectors, flags=None):
    rows = [(i * 3 + 1, "same", None if v is None else [None if e is None else float(e) for e in v], True if flags is None else flags[i], "n", "x", 0, 0) for i, v in enumerate(vectors)]
    return spark.createDataFrame(rows, SCHEMA)


def brute(vectors, k, keep=None):
    x = np.array([v for i, v in enumerate(vectors) if keep is None or i in keep], np.float32).astype(np.float64)
    numbers = [i * 3 + 1 for i in range(len(vectors)) if keep is None or i in keep]
    pairs = set()
    for i, n in enumerate(numbers):
        d = ((x - x[i]) ** 2).sum(1)
        order = sorted((d[j], m) for j, m in enumerate(numbers) if j != i)
        pairs |= {(min(n, m), max(n, m)) for _, m in order[:k]}
    return pairs


def got(frame, size, k=5):
    rows = [tuple(r) for r in nearest_pairs(frame, k=k, size=size).collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


def clustered(n, size, seed):
    random = np.random.default_rng(seed)
    centres = random.normal(0, 10, (max(2, n // 20), size))
    return np.round((centres[random.integers(len(centres), size=n)] + random.normal(0, 0.3, (n, size))) * 64) / 64


@pytest.mark.parametrize("shape", ["clustered", "uniform", "grid", "copies", "far"])
def test_against_brute_force(spark, shape):
    random = np.random.default_rng(5)
    x = {
        "clustered": lambda: clustered(400, 12, 1),
        "uniform": lambda: random.random((300, 6)),
        "grid": lambda: random.integers(0, 3, (300, 4)),  # ties and copies
        "copies": lambda: np.r_[np.repeat(random.random((3, 4)), [120, 5, 2], 0), random.random((20, 4))],
        "far": lambda: np.r_[random.random((100, 4)), 1e6 + random.random((7, 4)), -np.ones((1, 4)) * 3e7],
    }[shape]()
    assert got(table(spark, x.tolist()), x.shape[1]) == brute(x.tolist(), 5)


def test_many_cells_and_slabs(spark, monkeypatch):
    """Slabs, chunks and visits so small that every path is taken."""
    for name, value in (("BLOCK", 16), ("CHUNK", 8), ("TILE", 8), ("WIDE", 8), ("FIRST_BLOCKS", 1), ("SAMPLE", 64), ("HELD", 100), ("SPREAD", 5)):
        monkeypatch.setattr(neighbours, name, value)
    x = clustered(300, 8, 2)
    assert got(table(spark, x.tolist()), 8) == brute(x.tolist(), 5)


def test_rows_that_take_no_part(spark):
    x = [[0, 0], [1, 0], None, [1], [1, 2, 3], [None, 1], [float("nan"), 0], [float("inf"), 0], [2, 0], [-0.0, 0], [5, 5], [6, 6]]
    flags = [True] * 10 + [False, None]
    assert got(table(spark, x, flags), 2, k=1) == brute([[0, 0] if v is None or len(v) != 2 else v for v in x], 1, {0, 1, 8, 9})


def test_few_rows(spark):
    assert got(table(spark, []), 2) == set()
    assert got(table(spark, [[1, 2]]), 2) == set()
    assert got(table(spark, [[1, 2]] * 3), 2) == {(1, 4), (1, 7), (4, 7)}


def test_bounds_hold():
    """What a grid calls the least distance of a cell is never above that of its members."""
    x = clustered(500, 10, 3)
    grid = Grid(x[:200], 20)
    cell = neighbours._nearest(x, grid.centroids)
    away = np.sqrt(((x - grid.centroids[cell]) ** 2).sum(1))
    used = np.unique(cell)
    grid.fill(used, np.array([away[cell == c].max() for c in used]), np.array([(cell == c).sum() for c in used]))
    least = grid.least(x[:50], cell[:50])
    true = np.sqrt(((x[:50, None] - x[None]) ** 2).sum(2))
    for c in used:
        if c in cell[:50]:
            rows = cell[:50] != c
            assert (least[rows, c] <= true[:, cell == c].min(1)[rows] + 1e-9).all()
    numbers = np.arange(500)
    best = block_search(x[:50], numbers[:50], x, numbers, 3, np.full(50, np.inf))
    np.fill_diagonal(true[:, :50], np.inf)
    assert np.allclose(np.sqrt(best.square), np.sort(true, 1)[:, :3])


def test_blocks_hold_every_cell(monkeypatch):
    monkeypatch.setattr(neighbours, "BLOCK", 40)
    x = np.r_[clustered(500, 10, 3), np.repeat(clustered(1, 10, 4), 100, 0)]
    grid = Grid(x[::3], 30)
    cell = neighbours._nearest(x, grid.centroids)
    count = np.bincount(cell, minlength=len(grid.centroids))
    used = np.flatnonzero(count)
    grid.fill(used, np.full(len(used), 99.0), count[used])
    rows = np.zeros(grid.blocks)
    for c in used:
        assert grid.parts[c] == -(-count[c] // 40) or grid.parts[c] == 1
        rows[grid.base[c] : grid.base[c] + grid.parts[c]] += count[c] / grid.parts[c]
    assert rows.sum() == 600 and 0 < rows.min() and rows.max() <= 40
    # With an endless bound all blocks but the own one are open, each once.
    own = cell[:7]
    block = grid.base[own] + grid.parts[own] - 1
    for mine, blocks in zip(block, grid.open_blocks(x[:7], own, block, np.full(7, np.inf)), strict=True):
        assert sorted([mine, *blocks]) == list(range(grid.blocks))


@pytest.mark.parametrize("size", [256, 257, 1500])
def test_products_of_codes_are_exact(size):
    """Also where all codes are at the end of their range and sums of squares pass what float32 holds."""
    x = np.where(np.random.default_rng(1).random((40, size)) < 0.5, -1.0, 1.0)
    codes, missed = Codes(x).of(x)
    assert np.abs(codes).max() == 127 and missed.max() < 1
    whole = codes.astype(np.int64)
    assert ((codes**2).sum(1)[:, None] + (codes**2).sum(1) - 2 * (codes @ codes.T) == ((whole[:, None] - whole[None]) ** 2).sum(2)).all()


def test_sql(spark, folder, database):
    from comparing import rows_of, rows_of_sql

    from siftmill.llm.oracle import ORACLE
    from siftmill.llm.queries import p1_found

    assert rows_of(p1_found(spark, folder)) == rows_of_sql(database, ORACLE["p1_found"])

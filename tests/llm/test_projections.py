import math

import numpy as np
import pytest

from gleanery.llm import projections

from .helpers import Sets, clashing

DDL = "vec_id long, embedding array<float>, label int"


def plain(rows, threshold):
    sets, links, good = Sets(), {}, []
    for n, (i, v, label) in enumerate(rows):
        usable = i is not None and label is not None and v and all(x is not None and math.isfinite(x) for x in v) and any(v)
        good.append(np.array(v, float) / np.linalg.norm(v) if usable else None)
        links[n] = 0
    for a in range(len(rows)):
        for b in range(len(rows)):
            x, y = good[a], good[b]
            if a != b and x is not None and y is not None and len(x) == len(y) and rows[a][2] == rows[b][2] and x @ y >= threshold:
                links[a] += 1
                sets.join(rows[a][0], rows[b][0])
    out = [(i, links[n], i if i is None else sets.root(i)) for n, (i, _, _) in enumerate(rows)]
    return sorted([(i, n, c, i == c) for i, n, c in out], key=str)


def found(spark, rows, threshold, **kw):
    df = spark.createDataFrame([(i, v, label) for i, v, label in rows], DDL)
    return sorted((tuple(r) for r in projections.near_duplicates(clashing(df), threshold, **kw).collect()), key=str)


def clusters(seed, n, width=24):
    rng = np.random.default_rng(seed)
    centres = rng.normal(0, 1, (8, width))
    rows = []
    for i in range(n):
        v = centres[rng.integers(8)] + rng.normal(0, rng.choice([0.05, 0.12, 0.3]), width)
        rows.append((i, [float(np.float32(x)) for x in v], int(rng.integers(2))))
    return rows


@pytest.mark.parametrize("block", [projections.BLOCK, 13])
@pytest.mark.parametrize("threshold", [0.98, 0.9])
def test_against_all_pairs(spark, block, threshold):
    rows = clusters(3, 180)
    rows += [(200 + i, rows[5][1], rows[5][2]) for i in range(20)]
    assert found(spark, rows, threshold, block=block) == plain(rows, threshold)


def test_odd_rows(spark):
    v = [1.0, 2.0, 3.0]
    rows = [(1, v, 1), (2, v, 1), (3, [2.0, 4.0, 6.0], 1), (4, v, None), (5, None, 1), (6, [], 1), (7, [0.0] * 3, 1),
            (8, [1.0, None, 3.0], 1), (9, [1.0, math.nan, 3.0], 1), (10, [math.inf, 1.0, 1.0], 1), (11, [1.0, 2.0], 1),
            (12, [1e-30, 2e-30, 3e-30], 1), (13, [1e30, 2e30, 3e30], 1), (14, [-0.0, 0.0, 1.0], 1), (15, [0.0, 0.0, 1.0], 1),
            (None, v, 1)]
    assert found(spark, rows, 0.98) == plain(rows, 0.98)
    assert found(spark, [], 0.98) == []


def test_the_count_loses_no_pair_at_the_threshold():
    rng = np.random.default_rng(2)
    a = projections.unit_rows(rng.normal(0, 1, (300, 32)))
    away = rng.normal(0, 1, (300, 32))
    away -= (away * a).sum(axis=1, keepdims=True) * a
    b = 0.980001 * a + math.sqrt(1 - 0.980001**2) * projections.unit_rows(away)
    hits = dict(projections.SortedProjections(b, 0.98).links(a))
    assert all(i in hits[i] for i in range(300))


def cells_of(units, block, threshold):
    """The visits of one label, with its projections."""
    used = max(0, math.ceil(math.log2(len(units) / block)))
    values = units @ projections.directions(units.shape[1])[:, : projections.CUTS]
    cuts = np.tile(values.mean(axis=0), (len(units), 1))
    reach = projections.squared_reach(threshold) + 1e-9
    return projections.visited_cells(values, cuts, np.full(len(units), used), reach), 2**used


@pytest.mark.parametrize("threshold", [0.98, 0.9])
def test_linked_rows_meet_in_one_cell(threshold):
    rng = np.random.default_rng(5)
    centres = projections.unit_rows(rng.normal(0, 1, (40, 32)))
    units = projections.unit_rows(centres[rng.integers(40, size=1500)] + rng.normal(0, 0.028, (1500, 32)))
    (row, cell, home), _ = cells_of(units, 8, threshold)
    where = dict(zip(row[home].tolist(), cell[home].tolist()))
    assert len(where) == home.sum() == 1500
    seen = set(zip(row.tolist(), cell.tolist()))
    assert len(seen) == len(row)
    linked = np.argwhere(np.triu(units @ units.T >= threshold, 1)).tolist()
    assert len(linked) > 1000 and len({where[a] for a, _ in linked}) > 20
    for a, b in linked:
        low, high = sorted((a, b), key=where.get)
        assert (low, where[high]) in seen
    assert all(c >= where[r] for r, c in seen)


def test_compared_pairs_grow_less_than_quadratically():
    """One label, without any clusters: of sixteen times the rows, each visits less than eight times the cells."""
    rng = np.random.default_rng(6)
    visits = []
    for n in (1 << 12, 1 << 16):
        units = projections.unit_rows(rng.normal(0, 1, (n, 64)))
        (row, _, _), _ = cells_of(units, 16, 0.98)
        visits.append(len(row) / n)
    assert visits[1] / visits[0] < 8


@pytest.mark.parametrize("block", [3, 11])
def test_one_label_in_many_cells(spark, block):
    rows = [(i, v, 1) for i, v, _ in clusters(9, 150)]
    rows += [(300 + i, [1.0 + i * 1e-4, *[0.5] * 23], 1) for i in range(40)]
    rows += [(400 + i, [1.0, 0.1 * i], 1) for i in range(20)] + [(500 + i, [float(i + 1)], 1) for i in range(9)]
    assert found(spark, rows, 0.95, block=block) == plain(rows, 0.95)

import math

import numpy as np
import pytest

from gleanery.llm import topk

from .helpers import clashing

DDL = "vec_id long, embedding array<float>, label int"


def plain(rows, k, every):
    whole = {}
    for i, v in rows:
        if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v):
            v = [math.floor(64 * float(np.float32(x))) for x in v]
            whole[i] = min(whole.get(i, v), v)
    out = []
    for q, a in whole.items():
        if q % every == 0:
            scored = sorted((-sum(x * y for x, y in zip(a, b)), i) for i, b in whole.items() if i != q)[:k]
            out += [(q, n + 1, i, -s) for n, (s, i) in enumerate(scored)]
    return sorted(out)


def found(spark, rows, k, every, **blocks):
    df = spark.createDataFrame([(i, v, 0) for i, v in rows], DDL)
    return sorted(tuple(r) for r in topk.top_k(clashing(df), k, every, **blocks).collect())


@pytest.mark.parametrize("blocks", [{}, {"row_block": 40, "query_block": 7}])
def test_against_all_scores(spark, blocks):
    rng = np.random.default_rng(1)
    rows = [(int(i), [float(x) for x in rng.normal(0, 1, 40)]) for i in range(230)]
    assert found(spark, rows, 5, 10, **blocks) == plain(rows, 5, 10)


def test_ties_odd_vectors_and_ids(spark):
    rows = [(i, [1.0, 0.5] if i % 3 else [1.0, -0.5]) for i in range(30)]
    rows += [(30, None), (40, [1.0, None]), (50, [1.0, math.inf]), (60, [math.nan, 0.0]), (None, [1.0, 1.0]), (70, [])]
    rows += [(80, [2.0]), (90, [0.25] * 5), (0, [9.0, 9.0]), (10, [1.0, 0.5]), (10, [1.0, 0.5])]
    assert found(spark, rows, 4, 10) == plain(rows, 4, 10)


def test_few_candidates_and_empty(spark):
    assert found(spark, [(0, [1.0])], 3, 1) == []
    assert found(spark, [(0, [1.0]), (1, [-2.0])], 3, 1) == [(0, 1, 1, -8192), (1, 1, 0, -8192)]
    assert found(spark, [], 3, 1) == []


def test_scores_beyond_doubles_are_ranked_exactly(spark):
    rows = [(0, [3e7, 3e7]), (1, [3e7, 1.0]), (2, [3e7, 1.015625]), (3, [3e7, 0.0])]
    assert found(spark, rows, 3, 2) == plain(rows, 3, 2)
    huge = found(spark, [(0, [1e30]), (1, [1e30])], 1, 2)
    assert huge == [(0, 1, 1, 2**63 - 1)]


def test_components_beyond_64_bits(spark):
    rows = [(0, [1.0, 0.0]), (1, [1e18, 0.0]), (2, [3e33, 0.0]), (3, [-1e30, 0.0]), (4, [1e17, 0.5]), (5, [1e308, 0.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = [tuple(r) for r in topk.top_k(df, 5, every=20).orderBy("rank").select("vec_id", "score").collect()]
    top, low = 2**63 - 1, -(2**63)
    assert got == [(5, top), (2, top), (1, top), (4, top), (3, low)]

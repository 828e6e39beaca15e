import random

import pytest

from gleanery.llm.components import components

from .helpers import Sets


@pytest.mark.parametrize("kind", ["random", "path", "star", "none"])
def test_components(spark, kind):
    r = random.Random(4)
    names = r.sample(range(10**6), 300)
    links = {
        "random": [(r.choice(names), r.choice(names)) for _ in range(200)],
        "path": list(zip(names, names[1:])),
        "star": [(names[0], x) for x in names],
        "none": [(1, 1), (None, 2), (3, None)],
    }[kind]
    sets = Sets()
    for a, b in links:
        if a is not None and b is not None:
            sets.join(a, b)
    expected = {x: sets.root(x) for x in sets.parent if sets.root(x) != x}
    df = spark.createDataFrame(links + links, "a long, b long").repartition(7)
    assert {r.id: r.component for r in components(df).collect()} == expected

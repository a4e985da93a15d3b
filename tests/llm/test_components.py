"""Alternating stars against a walk over the links."""

import random

import pytest

from parcelyard.llm.components import components
from parcelyard.llm.workspace import Workspace


def walked(links):
    near = {}
    for a, b in links:
        if a is not None and b is not None and a != b:
            near.setdefault(a, set()).add(b)
            near.setdefault(b, set()).add(a)
    found = {}
    for start in sorted(near):
        todo = [start] if start not in found else []
        while todo:
            node = todo.pop()
            if node not in found:
                found[node] = start
                todo += near[node]
    return found


@pytest.mark.parametrize("shape", ["random", "path", "star", "odd"])
def test_components(spark, shape):
    rng = random.Random(shape)
    links = {
        "random": [(rng.randrange(90), rng.randrange(90)) for _ in range(70)],
        "path": [(i, i + 1) for i in rng.sample(range(60), 60)],
        "star": [(50, i) for i in range(100)],
        "odd": [(3, 3), (5, 2), (2, 5), (5, 2), (None, 1), (7, None)],
    }[shape]
    frame = spark.createDataFrame(links, "a long, b long")
    found = components(Workspace(spark, "test"), frame, "components")
    rows = [(r.node, r.component) for r in found.collect()]
    assert len(rows) == len(set(rows))
    assert dict(rows) == walked(links)

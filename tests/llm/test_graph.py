"""Links joined up within a task: same components as the links, also when the task writes in several parts."""

import random

import pandas as pd
import pytest

from corate.llm import graph


def parts(pairs):
    up = {}

    def root(x):
        while up.setdefault(x, x) != x:
            x = up[x]
        return x

    for a, b in pairs:
        a, b = root(a), root(b)
        up[max(a, b)] = min(a, b)
    return {(x, root(x)) for x in up if root(x) != x}


@pytest.mark.parametrize("held", [1, 7, 1 << 17])
def test_forest(monkeypatch, held):
    monkeypatch.setattr(graph, "HELD", held)
    r = random.Random(held)
    links = [(f"{r.randrange(120):03}", f"{r.randrange(120):03}") for _ in range(150)] + [("200", "200")]
    batches = [pd.DataFrame(links[i: i + 9], columns=["a", "b"]) for i in range(0, len(links), 9)]
    got = [(a, b) for out in graph._forest(iter(batches)) for a, b in zip(out["a"], out["b"], strict=True)]
    assert parts(got) == parts(links) and all(a > b for a, b in got)
    if held > 200:
        assert sorted(got) == sorted(parts(links))


def test_forest_of_nothing():
    assert list(graph._forest(iter([]))) == []

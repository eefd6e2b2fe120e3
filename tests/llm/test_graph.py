"""Connected components against union and find."""

import random

import pytest

from stagecheck.llm.graph import components


def brute(links):
    root = {}

    def find(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x

    for a, b in links:
        if a is not None and b is not None and a != b:
            low, high = sorted((find(a), find(b)))
            root[high] = low
    return {x: find(x) for x in root}


@pytest.mark.parametrize("seed", [1, 2])
def test_random_links(spark, seed):
    draw = random.Random(seed)
    links = [(draw.randrange(60), draw.randrange(60)) for _ in range(35)] + [(5, 5), (None, 3), (4, None)]
    links += [(100 + i, 101 + i) for i in range(25)] + links[:5]  # a chain, and repeats
    draw.shuffle(links)
    df = spark.createDataFrame([(a, b, "x") for a, b in links], "a long, b long, node string")
    assert {r.node: r.root for r in components(df).collect()} == brute(links)


def test_star_texts_and_nothing(spark):
    star = [("hub", f"s{i:03d}") for i in range(300)]
    df = spark.createDataFrame(star, "a string, b string")
    got = components(df).collect()
    assert len(got) == 301 and {r.root for r in got} == {"hub"}
    assert components(df.where("false")).count() == 0

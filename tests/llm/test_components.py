import random

from tidemark.llm import components


def test_roots_of_random_links(spark):
    rng = random.Random(1)
    links = [(rng.randint(-50, 400), rng.randint(-50, 400)) for _ in range(260)] + [(k, k + 1) for k in range(1000, 1040)] + [(7, 7)]
    got = {r["node"]: r["root"] for r in components.roots(spark.createDataFrame(links, "a long, b long")).collect()}
    root = {x: x for pair in links for x in pair}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    assert got == {x: find(x) for x in root if find(x) != x}


def test_no_links(spark):
    assert components.roots(spark.createDataFrame([], "a long, b long")).count() == 0

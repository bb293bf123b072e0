import random

from newsflow.llm.components import connected_components


def expected(links):
    root = {}
    find = lambda x: x if root.setdefault(x, x) == x else find(root[x])
    for a, b in links:
        if a is not None and b is not None and a != b:
            x, y = sorted((find(a), find(b)))
            root[y] = x
    return {x: find(x) for x in root}


def got(spark, links):
    rows = connected_components(spark.createDataFrame(links, "a long, b long"), "a", "b").collect()
    assert len(rows) == len({r.node for r in rows})
    return {r.node: r.root for r in rows}


def test_random_chains_and_stars(spark):
    rng = random.Random(4)
    chain = list(range(1000, 1200))
    rng.shuffle(chain)
    links = [(rng.randrange(300), rng.randrange(300)) for _ in range(140)] + list(zip(chain, chain[1:], strict=False)) + [(5000, 5000 + i) for i in range(1, 400)] + [(7, None), (None, 8), (9, 9), (-5, 3), (-5, 3)]
    assert got(spark, links) == expected(links)


def test_no_links(spark):
    assert connected_components(spark.createDataFrame([], "a long, b long"), "a", "b").count() == 0

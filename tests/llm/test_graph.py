import random

from lakeshift.llm import graph


def _smallest(edges):
    parent = {}

    def find(i):
        parent.setdefault(i, i)
        while parent[i] != i:
            i = parent[i]
        return i

    for a, b in edges:
        a, b = sorted((find(a), find(b)))
        parent[b] = a
    return {i: find(i) for i in list(parent)}


def _hubs(rng):
    """Hubs that share members."""
    nodes = rng.sample(range(10_000), 330)
    return [(hub, member) for member in nodes[30:] for hub in rng.sample(nodes[:30], 12)]


def _chain(rng):
    nodes = rng.sample(range(30_000, 31_000), 40)
    return list(zip(nodes, nodes[1:]))


def _table(spark, edges):
    return spark.createDataFrame(edges, "a long, b long")


def test_components_of_many_shapes(spark):
    """Chains in and out of order, sparse random edges, loops and repeated edges."""
    rng = random.Random(1)
    edges = _hubs(rng) + _chain(rng) + [(20_000 + i, 20_001 + i) for i in range(50)]
    edges += [(rng.randrange(40_000, 40_300), rng.randrange(40_000, 40_300)) for _ in range(200)]
    edges += [(50_000, 50_000)] + edges[:50] + [(b, a) for a, b in edges[-50:]]
    got = graph.components(_table(spark, edges)).collect()
    assert len(got) == len({r["node"] for r in got})
    assert {r["node"]: r["comp"] for r in got} == _smallest(edges)
    assert graph.components(_table(spark, [])).collect() == []


def test_rounds_do_not_join_the_edges_of_a_group_again(spark, monkeypatch):
    """Members that share hubs beside a chain, which takes more rounds: the rows of all joins stay within thrice the edges."""
    rng = random.Random(3)
    edges = _hubs(rng) + _chain(rng)
    frame, joins = type(spark.range(1)), []
    real = frame.join

    def join(self, *a, **k):
        joins.append(out := real(self, *a, **k))
        return out

    monkeypatch.setattr(frame, "join", join)
    got = {r["node"]: r["comp"] for r in graph.components(_table(spark, edges)).collect()}
    assert got == _smallest(edges)
    assert sum(j.count() for j in joins) < 3 * 2 * len(edges)

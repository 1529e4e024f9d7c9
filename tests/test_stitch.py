from soundline import queries
from soundline.operators import graph
from soundline.sources.fixtures import layer

SF = "/root/testdata/sf0.001"


def _kruskal(candidates, linked, cap=None):
    """One walk over the candidates in order, seeded with the links there are."""
    up, used = {}, {}

    def find(x):
        while up.get(x, x) != x:
            x = up[x]
        return x

    there = {frozenset(e) for e in linked}
    for e in there:
        p, q = map(find, tuple(e))
        up[p] = q
        for x in e:
            used[x] = used.get(x, 0) + 1
    out = set()
    for d2, a, b in sorted(candidates):
        if cap is None:
            if (p := find(a)) != (q := find(b)):
                up[p] = q
                out.add((a, b, d2))
        elif frozenset((a, b)) not in there and used.get(a, 0) < cap and used.get(b, 0) < cap:
            used[a], used[b] = used.get(a, 0) + 1, used.get(b, 0) + 1
            out.add((a, b, d2))
    return out


def _chart(spark):
    nodes = {r.k: r for r in layer(spark, SF, "chart_nodes").collect()}
    edges = [(r.u, r.v) for r in layer(spark, SF, "chart_edges").collect()]
    d2 = lambda a, b: (nodes[a].lon_e5 - nodes[b].lon_e5) ** 2 + (nodes[a].lat_e5 - nodes[b].lat_e5) ** 2
    return nodes, edges, d2


def test_stitch_components_as_brute_force(spark):
    nodes, edges, d2 = _chart(spark)
    near = [(d2(a, b), a, b) for a in nodes for b in nodes if a < b and d2(a, b) <= 1500**2]
    got = [(r.a, r.b, r.d2) for r in queries.stitch_components(spark, SF).collect()]
    assert len(got) == len(set(got)) and set(got) == _kruskal(near, edges)


def test_capped_connectors_as_brute_force(spark):
    nodes, edges, d2 = _chart(spark)
    kind = {k: r.node_type for k, r in nodes.items()}
    near = [(d2(a, b), a, b) for a in nodes for b in nodes if (kind[a], kind[b]) == ("inland", "coastal") and d2(a, b) <= 1500**2]
    got = [(r.a, r.b, r.d2) for r in queries.capped_connectors(spark, SF).collect()]
    assert len(got) == len(set(got)) and set(got) == _kruskal(near, [e for e in edges if kind[e[0]] != kind[e[1]]], 2)


def test_seeded_links_count(spark):
    links = spark.createDataFrame([(1, 2), (2, 3), (2, 1)], "u long, v long")
    pieces = spark.createDataFrame([(1, 1), (2, 1), (3, 1), (4, 4)], "k long, component long")
    asked = spark.createDataFrame([(1, 3, 1), (2, 4, 2), (3, 4, 3)], "a long, b long, d2 long")
    assert [tuple(r) for r in graph.stitch(asked, pieces).collect()] == [(2, 4, 2)]
    assert sorted(tuple(r) for r in graph.capped_connectors(asked, links, 2).collect()) == [(1, 3, 1)]

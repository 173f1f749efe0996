"""Cut vertices and bounded subgraphs against plain Python on small graphs and on a whole table."""

import random

import pytest
from pyspark.sql import functions as F

from conftest import SMALL
from vitrine.operators.biconnected import biconnected, cut_members, cut_vertices
from vitrine.operators.subgraph import bounded_subgraph, expand


def groups(pairs, nodes):
    name = {n: n for n in nodes}

    def top(n):
        while name[n] != n:
            n = name[n]
        return n

    for a, b in pairs:
        name[max(top(a), top(b))] = min(top(a), top(b))
    return {n: top(n) for n in nodes}


def split_by_removal(edges):
    nodes = {n for e in edges for n in e}
    before = len(set(groups(edges, nodes).values()))
    return [n for n in sorted(nodes) if len(set(groups([e for e in edges if n not in e], nodes - {n}).values())) > before]


def test_cut_vertices_of_two_rings(spark):
    edges = spark.createDataFrame([(1, 2), (2, 3), (3, 1), (3, 4), (4, 5), (10, 11), (7, 7), (2, 1)], "a long, b long")
    assert {r["node"]: r["blocks"] for r in cut_vertices(edges).collect()} == {3: 2, 4: 2}
    blocks = {}
    for r in biconnected(edges).collect():
        blocks.setdefault(r["block"], set()).add(r["node"])
    assert sorted(map(sorted, blocks.values())) == [[2, 3], [4], [5], [11]]
    assert cut_vertices(edges.limit(0)).count() == 0


@pytest.mark.parametrize(("seed", "nodes", "many"), [(3, 40, 38)])
def test_cut_vertices_equal_removal_of_every_node(spark, seed, nodes, many):
    rng = random.Random(seed)
    edges = sorted({tuple(sorted(rng.sample(range(nodes), 2))) for _ in range(many)})
    assert sorted(r["node"] for r in cut_vertices(spark.createDataFrame(edges, "a long, b long")).collect()) == split_by_removal(edges)


def test_levels_that_are_left_raise(spark):
    chain = spark.range(12).select(F.col("id").alias("a"), (F.col("id") + 1).alias("b"))
    with pytest.raises(RuntimeError):
        cut_vertices(chain, most_levels=5)


def test_cut_vertices_of_a_whole_table_equal_a_depth_first_search(spark):
    edges = spark.read.parquet(f"{SMALL}/lineitem.parquet").select((F.col("l_partkey") * 2).alias("a"), (F.col("l_orderkey") * 2 + 1).alias("b")).distinct()
    around = {}
    for a, b in edges.collect():
        around.setdefault(a, []).append(b)
        around.setdefault(b, []).append(a)
    order, low, cuts = {}, {}, set()
    for root in around:
        if root in order:
            continue
        order[root] = low[root] = len(order)
        stack, children = [(root, None, iter(around[root]))], 0
        while stack:
            node, parent, rest = stack[-1]
            child = next(rest, None)
            if child is None:
                stack.pop()
                if parent is not None:
                    low[parent] = min(low[parent], low[node])
                    if parent != root and low[node] >= order[parent]:
                        cuts.add(parent)
            elif child not in order:
                order[child] = low[child] = len(order)
                children += node == root
                stack.append((child, node, iter(around[child])))
            elif child != parent:
                low[node] = min(low[node], order[child])
        if children > 1:
            cuts.add(root)
    assert {r["node"] for r in cut_vertices(edges).collect()} == cuts


@pytest.mark.parametrize(("seed", "many"), [(5, 45), (6, 90)])
def test_cut_members_equal_removal_in_the_graph_with_groups(spark, seed, many):
    rng = random.Random(seed)
    pairs = sorted({(rng.randrange(30), rng.randrange(28)) for _ in range(many)})
    edges = [(2 * m, 2 * g + 1) for m, g in pairs]
    nodes = {n for e in edges for n in e}
    ring, want = groups(edges, nodes), {}
    for m in {m for m, _ in pairs}:
        rest = groups([e for e in edges if e[0] != 2 * m], nodes - {2 * m})
        parts = {rest[n] for n in nodes - {2 * m} if ring[n] == ring[2 * m]}
        if len(parts) > 1:
            want[m] = (len(parts), sum(p == m for p, _ in pairs))
    given = spark.createDataFrame([*pairs, *pairs[:9], (None, 1), (3, None)], "member long, group long")
    assert {r["member"]: (r["blocks"], r["degree"]) for r in cut_members(given).collect()} == want
    assert cut_members(given.limit(0)).count() == 0


def test_arcs_stay_in_their_buckets(spark, monkeypatch):
    from vitrine.operators import biconnected as module

    sent = []
    write = module.write_table

    def seen(df, tag):
        if tag == "forest-level":
            sent.append(df._jdf.queryExecution().executedPlan().toString())
        return write(df, tag)

    monkeypatch.setattr(module, "write_table", seen)
    edges = spark.createDataFrame([(i, i + 1) for i in range(6)], "a long, b long")
    assert cut_vertices(edges).count() == 5
    assert sum("Bucketed: true" in plan for plan in sent) >= 6


EDGES = [(1, 1), (2, 1), (2, 2), (3, 2), (3, 3), (4, 3), (4, 4), (5, 4), (6, 5), (7, 6), (7, 7), (8, 7), (9, 8), (9, 9), (3, 6)]


def frames(spark, persons, companies, rich):
    one = lambda rows, name: spark.createDataFrame([(r,) for r in rows], f"{name} long")
    edges = spark.createDataFrame(EDGES, "person long, company long")
    return edges, one(persons, "person"), one(companies, "company"), one(rich, "company")


def plain_expansion(persons, companies, rich, least=2):
    of = lambda firms: {p for p, c in EDGES if c in firms}
    firms = set(companies) | {c for p, c in EDGES if p in persons}
    kept = set(persons) | of(firms)
    more = {c for _, c in EDGES if c not in firms and (len(of({c}) & kept) >= least or (c in rich and of({c}) & kept))}
    return kept | of(more), firms | more


@pytest.mark.parametrize(("persons", "companies", "rich"), [([1], [], []), ([1], [], [3]), ([2], [8], [6]), ([], [5], [7]), ([99], [], [])])
def test_expansion_equals_sets(spark, persons, companies, rich):
    kept, firms = expand(*frames(spark, persons, companies, rich))
    assert ({r["person"] for r in kept.collect()}, {r["company"] for r in firms.collect()}) == plain_expansion(persons, companies, rich)


@pytest.mark.parametrize("cap", [5, 8, 100])
def test_bounded_view_takes_whole_components(spark, cap):
    args = ([1, 2, 3, 6, 9], [], [6, 7])
    kept, firms = plain_expansion(*args)
    edges = [(2 * p, 2 * c + 1) for p, c in EDGES if p in kept and c in firms]
    nodes = {n for e in edges for n in e}
    name, degree = groups(edges, nodes), {n: sum(n in e for e in edges) for n in nodes}
    rings = {}
    for n in nodes:
        rings.setdefault(name[n], []).append(n)
    want = set()
    for ring in sorted(rings.values(), key=lambda r: (-len(r), min(r))):
        if len(want) + len(ring) > cap:
            if not want:
                want = set(sorted(ring, key=lambda n: (-degree[n], n))[:cap])
            break
        want |= set(ring)
    left = {e for e in edges if e[0] in want and e[1] in want}
    got, links = bounded_subgraph(*frames(spark, *args), cap)
    rows = {r["node"]: r for r in got.collect()}
    assert set(rows) == {n for e in left for n in e} and {tuple(r) for r in links.collect()} == left
    again = groups(left, set(rows))
    assert all((rows[a]["cluster"] == rows[b]["cluster"]) == (again[a] == again[b]) for a in rows for b in rows)
    sizes = [sum(r["cluster"] == k for r in rows.values()) for k in range(len(set(again.values())))]
    assert sizes == sorted(sizes, reverse=True)

"""Blocked joins, the registry and linkage against plain Python over all pairs."""

import datetime
import itertools
import math
import random

import pytest
from pyspark.sql import functions as F

from vitrine.functions.similarity import _winkler
from vitrine.operators import linkage
from vitrine.operators.blocking import bounded_block_join
from vitrine.operators.merging import company_totals, groups, merged_array, safe_pairs
from vitrine.operators.registry import MATCH, REVIEW, resolve


@pytest.mark.parametrize("most", [1, 3, 1000])
def test_large_blocks_lose_no_pair(spark, most):
    left = spark.createDataFrame([(i, i % 3 if i > 30 else 7) for i in range(60)], "a long, k int")
    right = spark.createDataFrame([(i, i % 4 if i > 25 else 7) for i in range(50)], "c long, k int")
    got = bounded_block_join(left, right, ["k"], "a", "c", most)
    want = {(r[0], s[0]) for r in left.collect() for s in right.collect() if r[1] == s[1]}
    rows = [(r["a"], r["c"]) for r in got.collect()]
    assert set(rows) == want and len(rows) == len(want) and got.columns == ["k", "a", "c"]


def test_no_join_key_holds_more_than_its_share(spark):
    hot = spark.range(3000).select(F.col("id"), F.lit("x").alias("k"))
    pairs = bounded_block_join(hot.withColumnRenamed("id", "a"), hot.limit(2000).withColumnRenamed("id", "c"), ["k"], "a", "c", 500)
    assert pairs.count() == 6_000_000


NAMES = ["ion popescu", "popescu ion", "ion ionescu", "ion", "Ionesco Ion", "maria pop", "maria popescu ion", "pop maria elena", "mariana popa", "xu", "Ion Popescu Dr.", "elena", "elena ion", "stan", "stanciu ion maria", "ion vasile", "vasile"]


def key_of(name):
    words = "".join(c if c.isalpha() else " " for c in name.lower()).split()
    return " ".join(sorted({w for w in words if len(w) >= 2 and w != "dr"}))


def similar(a, b):
    if a == b:
        return 1.0
    x, y = set(a.split()), set(b.split())
    return round(0.6 * len(x & y) / len(x | y) + 0.4 * _winkler(a, b), 4)


@pytest.mark.parametrize("most", [2, 1000])
def test_registry_finds_all_that_reach_review(spark, most):
    rng = random.Random(5)
    day = lambda: rng.choice([None, datetime.date(1960, 1, 1), datetime.date(1961, 2, 2)])
    mentions = [(i, rng.choice(NAMES), day(), "s", None) for i in range(120)] + [(900, "  ", None, "s", None), (901, None, None, "s", None), (902, "no one at all", None, "s", "e1")]
    registry = [(f"p{i:02}", rng.choice(NAMES), day()) for i in range(40)]
    crosswalk = [("s", "e1", "p07"), ("s", "e1", "p03"), ("t", "e1", "p00")]
    got = resolve(
        spark.createDataFrame(mentions, "mention long, name string, birth_date date, system string, ext_id string"),
        spark.createDataFrame(registry, "person string, canonical string, birth_date date"),
        spark.createDataFrame(crosswalk, "system string, ext_id string, person string"),
        most,
    )
    rows = {r["mention"]: (r["status"], r["person"], r["score"]) for r in got.collect()}
    assert rows[900][0] == rows[901][0] == "INVALID" and rows[902] == ("MATCHED", "p03", 1.0)
    for mention, name, birth, _, _ in mentions[:120]:
        best = None
        for person, canonical, born in registry:
            a, c = key_of(name), key_of(canonical)
            if not {w[:4] for w in a.split()} & {w[:4] for w in c.split()}:
                continue
            score = similar(a, c)
            if birth and born:
                score = min(1.0, score + 0.3) if birth == born else score * 0.3
            if score >= REVIEW and (best is None or (-score, person) < best):
                best = (-score, person)
        status, person, score = rows[mention]
        if best is None:
            assert status == "NEW" and score is None
        else:
            assert status == ("MATCHED" if round(-best[0], 4) >= MATCH else "REVIEW")
            assert score == pytest.approx(-best[0], abs=1e-4) and person == best[1]


def plain_em(patterns, u, fields, free, prior, rounds):
    """Expectation-maximisation over every pair by itself."""
    pairs = [p for p, n in patterns for _ in range(n)]
    m = {f: [(k + 1) / sum(range(1, len(u[f]) + 1)) for k in range(len(u[f]))] for f in free}
    for _ in range(rounds):
        chance = []
        for pair in pairs:
            a, b = prior, 1 - prior
            for f, v in zip(fields, pair, strict=True):
                if f in free and v >= 0:
                    a, b = a * m[f][v], b * u[f][v]
            chance.append(a / (a + b))
        prior = sum(chance) / len(pairs)
        for f in free:
            mass = [1e-6 + sum(c for c, pair in zip(chance, pairs, strict=True) if pair[fields.index(f)] == v) for v in range(len(u[f]))]
            m[f] = [x / sum(mass) for x in mass]
    return m


def test_em_equals_a_plain_loop(spark):
    rng = random.Random(2)
    fields, u = ["name", "born", "org"], {"name": [0.9, 0.08, 0.02], "born": [0.95, 0.05], "org": [0.8, 0.2]}
    rows = []
    for i in range(400):
        same = rng.random() < 0.3
        draw = lambda good, f, same=same: rng.choices(range(len(u[f])), good if same else u[f])[0]
        rows.append((i, draw([0.1, 0.3, 0.6], "name"), -1 if rng.random() < 0.2 else draw([0.2, 0.8], "born"), draw([0.4, 0.6], "org")))
    compared = spark.createDataFrame(rows, "l long, name int, born int, org int")
    patterns = linkage.pattern_counts(compared, fields)
    assert sum(n for _, n in patterns) == 400
    for free in (fields, ["born", "org"]):
        got, want = linkage.fit(patterns, u, fields, free, 0.1, 20), plain_em(patterns, u, fields, free, 0.1, 20)
        assert set(got) == set(free)
        for f in free:
            assert got[f] == pytest.approx(want[f], rel=1e-6)


def test_u_prior_and_term_frequencies(spark):
    rng = random.Random(6)
    people = [(i, f"s{rng.randrange(40)}", rng.choice(["x", "x", "x", f"y{i % 5}"])) for i in range(200)] + [(999, None, None)]
    records = spark.createDataFrame(people, "id long, name string, org string")
    x, y = F.col("x"), F.col("y")
    level = lambda f: F.coalesce((x[f] == y[f]).cast("int"), F.lit(-1))
    everything = linkage.sampled_pairs(records, "id", 1e9)
    assert everything.count() == 201 * 200 // 2
    some = linkage.sampled_pairs(records, "id", 2000)
    assert 1400 < some.count() < 2600 and some.where("l >= r").count() == 0
    u = linkage.level_shares(linkage.compare(everything, records, "id", {"name": level("name")}), {"name": 2})["name"]
    same = sum(a[1] == b[1] for a, b in itertools.combinations(people[:200], 2))
    assert u == pytest.approx([(19900 - same + 1) / 19902, (same + 1) / 19902])
    either = sum(a[1] == b[1] or a[2] == b[2] for a, b in itertools.combinations(people[:200], 2))
    assert linkage.expected_prior(records, [[F.col("name")], [F.col("org")]], 0.7) == pytest.approx(either / 0.7 / (201 * 200 / 2))
    tf = {r["value"]: r["tf"] for r in linkage.frequencies(records, "org").collect()}
    assert sum(tf.values()) == pytest.approx(1.0) and None not in tf
    model = {"prior": 0.01, "m": {"org": [0.1, 0.9]}, "u": {"org": [0.7, 0.3]}}
    pairs = spark.createDataFrame([(1, 2, 1, 0.6), (1, 3, 1, 0.01), (1, 4, 0, None), (1, 5, -1, None)], "l long, r long, org int, tf double")
    bits = {r["r"]: r["weight"] for r in linkage.score(pairs, model, ["org"], {"org": "tf"}).collect()}
    prior = math.log2(0.01 / 0.99)
    assert bits == pytest.approx({2: prior + math.log2(0.9 / 0.6), 3: prior + math.log2(0.9 / 0.01), 4: prior + math.log2(0.1 / 0.7), 5: prior})


def test_training_tells_people_apart(spark):
    from conftest import SMALL
    from vitrine.plans import catalogue

    rows = catalogue.QUERIES["linkage_em"](spark, SMALL).collect()
    same = sum(r["l"] // 3 == r["r"] // 3 for r in rows)
    assert same >= 0.8 * len(rows) and same >= 50


def test_only_subsets_with_a_common_organisation_merge(spark):
    rows = [(1, ["ion", "pop"], ["a"]), (2, ["ion", "pop", "stan"], ["a", "b"]), (3, ["ion", "pop"], ["b"]), (4, ["ion"], ["c"]), (5, [], ["a"]), (6, ["ion", "pop"], ["a"])]
    records = spark.createDataFrame(rows, "id long, name_tokens array<string>, org_tokens array<string>")
    pairs = spark.createDataFrame([(1, 2, 0.95), (2, 3, 0.9), (2, 4, 0.99), (1, 3, 0.99), (1, 5, 0.99), (2, 6, 0.89)], "l long, r long, probability double")
    safe = safe_pairs(pairs, records)
    assert sorted(tuple(r) for r in safe.collect()) == [(1, 2), (2, 3)]
    placed = {r["id"]: (r["canonical"], r["turn"]) for r in groups(safe, records, []).collect()}
    assert placed == {2: (2, 0), 1: (2, 1), 3: (2, 2)}


def test_nested_arrays_merge_by_key_in_order(spark):
    members = spark.createDataFrame([(2, 2, 0), (1, 2, 1), (3, 2, 2)], "id long, canonical long, turn int")
    arrays = [(1, [(7, "A "), (8, "b")]), (2, [(9, "z"), (7, " a")]), (3, [(8, "B"), (None, None), (None, None)])]
    records = spark.createDataFrame(arrays, "id long, c array<struct<cui: long, name: string>>")
    got = merged_array(members, records, "c", [F.col("x.cui"), F.lower(F.trim("x.name"))]).first()["c"]
    assert [tuple(x) for x in got] == [(9, "z"), (7, " a"), (8, "b"), (None, None)]
    assert len(merged_array(members, records, "c", [F.col("x.cui")], 2).first()["c"]) == 2


def test_contracts_count_once_for_each_company(spark):
    rows = [([(1, 5.0, 1.0), (1, 7.0, None), (2, None, 2.5), (None, 3.0, None), (1, None, 4.0)],), ([],)]
    df = spark.createDataFrame(rows, "c array<struct<cui: long, contracts: double, direct: double>>")
    got = [tuple(map(float, r["t"])) for r in df.select(company_totals(F.col("c")).alias("t")).collect()]
    assert got == [(3.0, 2.0, 10.0, 7.5), (0.0, 0.0, 0.0, 0.0)]


def test_block_joins_are_dealt_by_their_pairs(spark, monkeypatch):
    """A few small rows that make many pairs are not one task's work."""
    from vitrine.operators import blocking

    monkeypatch.setattr(blocking, "PAIRS", 5000)
    rows = spark.range(2000).selectExpr("id", "id % 10 AS k")
    joined = blocking.bounded_block_join(rows.toDF("l", "k"), rows.toDF("r", "k"), ["k"], "l", "r", 50)
    per = joined.groupBy(F.spark_partition_id()).count().collect()
    assert sum(r["count"] for r in per) == 10 * 200 * 200 and len(per) > 40 and max(r["count"] for r in per) < 40_000


def test_pairs_of_several_rules_are_made_once_and_not_shuffled(spark):
    rows = [(1, "a", 1), (2, "a", 1), (3, "a", None), (4, None, 1), (5, None, None), (6, "b", 1)]
    pairs = linkage.blocked_pairs(spark.createDataFrame(rows, "id int, x string, y int"), "id", [[F.col("x")], [F.col("y")], [F.col("x"), F.col("y")]])
    assert sorted(map(tuple, pairs.collect())) == [(1, 2), (1, 3), (1, 4), (1, 6), (2, 3), (2, 4), (2, 6), (4, 6)]
    assert not [line for line in pairs._jdf.queryExecution().optimizedPlan().toString().splitlines()[:3] if "Aggregate" in line]


def test_names_compared_together_equal_names_compared_one_by_one(spark):
    import random

    from vitrine.functions.similarity import _winkler, _winklers, jaro_winkler, may_reach

    rng = random.Random(5)
    word = lambda: "".join(rng.choice("abcdă n") for _ in range(rng.randint(0, 9)))
    pairs = [(a, b) for a, b in ((word(), word()) for _ in range(4000)) if a != b]
    assert _winklers(*map(list, zip(*pairs, strict=True))).tolist() == [_winkler(*p) for p in pairs]
    df = spark.createDataFrame([*pairs, ("x" * 40, "x" * 39 + "y"), ("a", None), ("", "")], "a string, b string")
    missed = df.where((jaro_winkler("a", "b") >= 0.88) & ~may_reach(F.col("a"), F.col("b"), 0.88))
    told = df.where(~may_reach(F.col("a"), F.col("b"), 0.88))
    assert missed.count() == 0 and told.count() > 1000


def test_overlaps_of_names_that_are_null(spark):
    from vitrine.plans.resolution import name_similarities, token_overlap_pairs

    part = spark.createDataFrame([(1, None, "b", "t", 1), (2, "red bolt", "b", "t", 1), (3, "red bolt", "c", "t", 1)], "p_partkey long, p_name string, p_brand string, p_type string, p_size int")
    assert sorted(map(tuple, token_overlap_pairs(lambda name: part).collect())) == [(1, 2, None, None), (2, 3, True, False)]
    assert [tuple(r) for r in name_similarities(lambda name: part).collect()] == [(2, 3, 1.0)]


def test_names_that_share_a_prefix_are_candidates(spark):
    """Every pair that shares the first four letters of a token, once, beside the pairs of the rules."""
    from vitrine.plans.resolution import blocking_candidates

    rows = [(1, "Ionescu Maria", "a"), (2, "dr Ionesco Marian", "b"), (3, "pop maria", "c"), (4, None, "d"), (5, "dr x1", "e"), (6, "Țepeș dr", "f"), (7, "tepesanu", "g"), (8, None, "d")]
    part = spark.createDataFrame([(i, name, brand, "t", 1) for i, name, brand in rows], "p_partkey long, p_name string, p_brand string, p_type string, p_size int")
    assert sorted(map(tuple, blocking_candidates(lambda name: part).collect())) == [(1, 2), (1, 3), (2, 3), (4, 8), (6, 7)]


def test_near_and_far_pairs_have_the_same_levels(spark):
    """Pairs told by letters alone have the levels of pairs that are compared, and none that can reach the least is left out."""
    from conftest import SMALL
    from vitrine.plans import resolution
    from vitrine.sources.tables import table

    _, pairs = resolution._blocks(resolution._records(lambda name: table(spark, SMALL, name)).where("id < 400"))
    names = resolution._names()
    rows = lambda df: sorted(map(tuple, df.collect()))
    whole = linkage.levels_of(pairs, resolution._compared_with(), None, names["costly"], names["settled"])
    parts = linkage.levels_of(pairs, resolution._compared_with(), **names)
    assert rows(whole) == rows(parts) and {r["name"] for r in whole.collect()} >= {0, 3, 5}
    levels = list(resolution._LEVELS)
    for least in (0.5, 0.9):
        some = linkage.levels_of(pairs, resolution._compared_with(), **names, worth=resolution._worth(resolution._MODEL, least))
        want = linkage.score(whole, resolution._MODEL, levels).where(F.col("probability") >= least)
        assert rows(linkage.score(some, resolution._MODEL, levels, least=least)) == rows(want)


def test_sketches_lose_no_names(spark):
    from vitrine.functions.similarity import may_reach_by, sketch

    rng = random.Random(9)
    word = lambda: "".join(rng.choice("abcdțé n") for _ in range(rng.randint(0, 9)))
    pairs = [(a, b, _winkler(a, b)) for a, b in [(word(), word()) for _ in range(3000)] + [("a" * 30, "a" * 29), ("aaaaab", "aaaaac")]]
    df = spark.createDataFrame(pairs, "a string, b string, jw double")
    told = df.select("jw", *[F.coalesce(may_reach_by(sketch("a"), sketch("b"), t), F.lit(True)).alias(f"t{i}") for i, t in enumerate((0.88, 0.92))]).collect()
    assert not [r for r in told if (r["jw"] >= 0.88 and not r["t0"]) or (r["jw"] >= 0.92 and not r["t1"])]
    assert sum(not r["t0"] for r in told) > 1500


def test_code_of_a_pair_is_short_enough_to_be_compiled(spark):
    """Java compiles no method beyond 8000 bytes."""
    import re

    from conftest import SMALL
    from vitrine.plans import resolution
    from vitrine.sources.tables import table

    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = resolution.linkage_scores(lambda name: table(spark, SMALL, name))._jdf.queryExecution()
        code = plan.explainString(spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("codegen"))
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    sizes = [int(n) for n in re.findall(r"maxMethodCodeSize:(\d+)", code)]
    assert len(sizes) > 10 and max(sizes) < 8000

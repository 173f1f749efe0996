"""Typed edges, neighbours, inverted indexes, watchlists and archives on small tables."""

from pyspark.sql import functions as F

from vitrine.operators import edges as op
from vitrine.operators import watchlists as lists
from vitrine.sources import files


def test_control_goes_to_the_known_organisation_first(spark):
    firms = spark.createDataFrame([("f1", "Min A", "o:a"), ("f2", "Min B", "o:b"), ("f3", None, "o:x")], "firm string, authority string, made string")
    organisations = spark.createDataFrame([("Min A", "org9"), ("Min A", "org1")], "name string, org string")
    got = {r["dst"]: (r["src"], r["props"]) for r in op.controls(firms, organisations, "state").collect()}
    assert got == {"f1": ("org1", '{"authority":"Min A"}'), "f2": ("o:b", '{"authority":"Min B"}'), "f3": ("state", "{}")}


def test_edges_without_an_end_go_and_repeats_count_once(spark):
    rows = spark.createDataFrame([(1, 2, "b"), (1, 2, "a"), (1, None, "c"), (None, 2, "d")], "x long, y long, p string")
    made = op.typed(rows, "T", F.col("x"), F.col("y"), p=F.col("p"))
    assert [tuple(r) for r in op.one_each([made, made]).collect()] == [("1", "2", "T", '{"p":"a"}')]


def test_neighbours_of_both_sides_without_hidden_kinds(spark):
    edges = spark.createDataFrame([("a", "b", "X"), ("c", "a", "Y"), ("a", "d", "Z"), ("e", "f", "X"), ("a", "b", "X")], "src string, dst string, type string")
    nodes = spark.createDataFrame([("a",), ("a",), ("f",), ("none",)], "node string")
    got = sorted(tuple(r) for r in op.neighbours(edges, nodes, ("Z",)).collect())
    assert got == [("a", "b", "X"), ("a", "c", "Y"), ("f", "e", "X")]
    assert op.neighbours(edges, nodes).count() == 4


def test_index_counts_all_and_shows_some(spark):
    rows = spark.createDataFrame([("k", i % 70) for i in range(140)] + [("l", 1), (None, 2), ("m", None)], "k string, v int")
    got = {r["k"]: (r["n"], r["items"]) for r in op.inverted(rows, "k", "v", 5).collect()}
    assert got == {"k": (70, [0, 1, 2, 3, 4]), "l": (1, [1])}


def test_published_graph_keeps_valid_links_only(spark):
    nodes = spark.createDataFrame([("a", "person"), ("b", "company"), ("c", "person")], "id string, kind string")
    edges = spark.createDataFrame([("a", "b", "T"), ("a", "gone", "T")], "src string, dst string, type string")
    folder = op.publish(nodes, edges)
    assert sorted(tuple(r) for r in files.read_lines(spark, f"{folder}/nodes", "id string, degree long").collect()) == [("a", 1), ("b", 1), ("c", 0)]
    assert [tuple(r) for r in files.read_lines(spark, f"{folder}/links", "source string, target string").collect()] == [("a", "b")]
    summary = files.read_lines(spark, f"{folder}/summary", "n_links long, kinds map<string, long>").first()
    assert summary["n_links"] == 1 and summary["kinds"] == {"company": 1, "person": 2}


STREAM = [
    ("1", "Person", {"name": ["Ion Pop", "I. P."], "country": ["fr", "RO"], "topics": ["sanction"]}),
    ("2", "Company", {"name": ["Ana Maria Stan"], "citizenship": ["România"], "position": ["x", "y"]}),
    ("3", "Person", {"name": ["Pop Ion"], "country": ["md"]}),
    ("4", "Vessel", {"name": ["Ion Pop"], "country": ["ro"]}),
    ("5", "Person", {"name": [], "country": ["ro"]}),
    ("6", "Person", None),
    ("7", "Person", {"name": ["Nobody Known"], "jurisdiction": ["rou"]}),
]
PERSONS = [(1, 2.0, False, "ion pop"), (2, 5.0, False, "ion pop"), (3, 5.0, True, "ion pop"), (4, 1.0, False, "ana maria stan"), (5, 9.0, False, "ion")]


def frames(spark):
    stream = spark.createDataFrame(STREAM, "id string, schema string, properties map<string, array<string>>")
    return stream, spark.createDataFrame(PERSONS, "person long, weight double, in_office boolean, key string")


def test_entities_are_filtered_by_schema_and_country(spark):
    stream, persons = frames(spark)
    got = {r["id"]: (r["name"], r["topics"], r["position"], r["person"]) for r in lists.flagged(lists.entities_of(stream), persons).collect()}
    assert got == {"1": ("Ion Pop", ["sanction"], None, 2), "2": ("Ana Maria Stan", [], "x", 4), "7": ("Nobody Known", [], None, None)}


def test_releases_give_confidence_by_words_and_office(spark):
    _, persons = frames(spark)
    mentions = [(i, "POP ION") for i in range(9)] + [(3, "ION POP"), (20, "STAN ANA-MARIA"), (21, "ION"), (22, "NEW NAME"), (23, None)]
    got = {r["key"]: (r["person"], r["n_releases"], r["releases"], r["confidence"]) for r in lists.press_matches(spark.createDataFrame(mentions, "release long, name string"), persons).collect()}
    assert got == {"ion pop": (2, 9, [0, 1, 2, 3, 4], "med"), "ana maria stan": (4, 1, [20], "high")}
    office = persons.where("person = 3")
    assert lists.press_matches(spark.createDataFrame(mentions, "release long, name string"), office).first()["confidence"] == "high"


def test_archive_summary_and_patch(spark):
    rows = [("Ion Pop", 2020, "deputat", "x"), ("POP ion", 2019, "y" * 80, None), ("ion pop", 2020, None, "x"), ("", 2000, "a", "b"), (None, 2000, "a", "b")] + [("ana maria stan", None, f"r{i}", "i") for i in range(9)]
    summary = lists.archive_summary(spark.createDataFrame(rows, "name string, year int, role string, institution string"))
    got = {r["key"]: tuple(r)[1:] for r in summary.collect()}
    assert got == {"ion pop": (3, [2019, 2020], ["deputat", "y" * 50], ["x"]), "ana maria stan": (9, [], [f"r{i}" for i in range(5)], ["i"])}
    _, persons = frames(spark)
    found = {r["person"]: r["archive"] for r in lists.patched(persons, summary).collect()}
    assert found[5] is None and found[1]["n"] == 3 and len(found) == 5

"""Work and memory that grow no faster than the tables: tasks by rows, joins done once, passes over a text."""

import pytest
from pyspark.sql import functions as F

from conftest import SMALL
from vitrine.functions import numbers, text
from vitrine.operators import gold
from vitrine.plans import catalogue, graphs
from vitrine.sources.tables import table


@pytest.mark.parametrize("name", ["person_rollup", "officials_contracts", "conflicted_suppliers", "board_and_office", "k_hop_network", "bounded_subgraph"])
def test_many_tasks_give_the_same_rows(name, spark, duck, same, monkeypatch):
    monkeypatch.setattr(gold, "TASK_ROWS", 300)
    same(catalogue.QUERIES[name](spark, SMALL), duck, catalogue.ORACLE_SQL[name])


def test_links_are_dealt_by_rows(spark, monkeypatch):
    monkeypatch.setattr(gold, "TASK_ROWS", 300)
    t = lambda name: table(spark, SMALL, name)
    assert gold.links(t).rdd.getNumPartitions() == t("lineitem").count() // 300 + 1


def test_network_joins_its_links_once(spark, monkeypatch):
    calls = []
    monkeypatch.setattr(graphs, "tied", lambda t: calls.append(1) or gold.tied(t))
    found = catalogue.QUERIES["k_hop_network"](spark, SMALL)
    assert found.count() and len(calls) == 1
    assert not any(f"/{name}.parquet" in file for file in found.inputFiles() for name in ("lineitem", "orders"))


def test_subgraph_makes_given_edges_distinct_once(spark, monkeypatch):
    from vitrine.operators import subgraph

    tags = []
    monkeypatch.setattr(subgraph, "write_table", lambda df, tag, f=subgraph.write_table: tags.append(tag) or f(df, tag))
    edges = spark.createDataFrame([(1, 1), (1, 1), (2, 1)], "person long, company long")
    seeds, none = spark.createDataFrame([(1,)], "person long"), spark.createDataFrame([], "company long")
    nodes, _ = subgraph.bounded_subgraph(edges, seeds, none, none, 10)
    assert sorted((r["id"], r["degree"]) for r in nodes.collect()) == [(1, 1), (1, 2), (2, 1)]
    assert tags.count("subgraph-given") == 1


def test_numbers_are_read_without_patterns(spark, capsys):
    odd = ["1.234,56", "1,234.56", "1.234.567", " 1 234,5", "1,2,3", ".", "-", "", "12,345", "1.2,3.4", "-1.234,5", None]
    df = spark.createDataFrame([(x,) for x in odd], "s string")
    got = [tuple(r) for r in df.select(*[numbers.parse_number(F.col("s"), how) for how in ("decimal", "thousands", "groups")]).collect()]
    assert got == [
        (1234.56,) * 3, (1234.56,) * 3, (None, 1234567.0, 1234567.0), (1234.5,) * 3, (None,) * 3, (None,) * 3, (None,) * 3, (None,) * 3, (12345.0,) * 3,
        (None,) * 3, (-1234.5,) * 3, (None,) * 3,
    ]
    df.select(numbers.parse_number(F.col("s"), "thousands")).explain()
    assert "regexp" not in capsys.readouterr().out.lower()


def test_citations_are_read_in_one_pass(spark, capsys):
    df = spark.createDataFrame([("legea 1/2010 LEGE  nr 1 / 2010, H.G.2/2004 hotărârea 3/2004",), (None,)], "t string")
    found = df.select(text.law_references(F.col("t")).alias("laws"))
    assert [r["laws"] for r in found.collect()] == [["lege/1/2010", "hg/2/2004", "hg/3/2004"], None]
    found.explain()
    assert capsys.readouterr().out.count("regexp_extract_all(t#") == 1


def test_lines_of_curricula_are_told_by_their_first_letter(spark, capsys):
    from vitrine.functions.published import curriculum

    words = ["STUDII", "Educații", "FORMARE", "absolvent", "Facultate", "UNIVERSITATE", "licență", "Master", "DOCTOR", "colegiu", "LICEU", "Diplomă", "specializare", "ACADEMIE"]
    work = ["Experiență", "ACTIVITATE PROFESIONALĂ", "funct", "Angajator", "PERIOADA", "director", "Manager", "ȘEF x", "sef y", "CONSILIER", "inginer", "Economist", "2001 - 2005", "2001–PREZENT"]
    df = spark.createDataFrame([("\n".join([*words, "xyz", *work, "qwt" * 20]),)], "t string").select(curriculum(F.col("t")).alias("c"))
    found = df.first()["c"]
    assert set(words) <= set(found["education"].split(" | ")) and found["experience"].split(" | ")[-len(work) :] == work
    assert "xyz" not in found["education"] + found["experience"]
    df.explain()
    assert "(?iu)(?=[" in capsys.readouterr().out

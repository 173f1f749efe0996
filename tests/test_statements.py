"""Dumps of financial statements."""

import pytest

from vitrine.sources.statements import statements


@pytest.fixture
def folder(tmp_path):
    row = lambda sep, cui, **i: sep.join([str(cui), "0111"] + [str(i.get(f"i{n}", n)) for n in range(1, 21)])
    (tmp_path / "1.txt").write_text("\n".join(["CUI;i20;I18;i19;i13", "7;12;0;5;1.234 lei", "x;1;1;1;1", "", "8;;-;0;-9", "7;99;99;99;99"]))
    (tmp_path / "2.txt").write_text("\n".join([row(",", 9, i18=40, i7="-", i13=""), row(",", 7), "10,0111,1", " 11 ,0111"]))
    (tmp_path / "3.txt").write_text("")
    return tmp_path


def read(spark, folder, keys):
    found = statements(spark, f"file://{folder}", spark.createDataFrame([(k,) for k in keys], "cui bigint"))
    return {r.cui: tuple(r)[1:] for r in found.collect()}


def test_layouts_and_first_rows(spark, folder):
    assert read(spark, folder, [7, 8, 9, 10, 11, 12, None, 7]) == {
        7: (1234, -5, None, 12), 8: (-9, None, None, None), 9: (None, 40, None, 20), 10: (None,) * 4, 11: (None,) * 4,
    }


def test_only_what_is_asked_for(spark, folder):
    assert set(read(spark, folder, [9])) == {9}
    assert read(spark, folder, []) == {}


def test_a_row_of_many_blocks_keeps_its_order(spark, tmp_path):
    (tmp_path / "a.txt").write_text("CUI;i13\n" + "\n".join(f"{i % 50};{i}" for i in range(20000)))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "16384")
    try:
        found = read(spark, tmp_path, range(50))
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert {k: v[0] for k, v in found.items()} == {i: i for i in range(50)}

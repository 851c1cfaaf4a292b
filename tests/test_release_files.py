"""The release files of incremental_releases hold no blanks between elements, and give every node."""

from datetime import date

from codetree.plans import queries


def test_release_files_are_written_without_indentation(spark, tmp_path, monkeypatch):
    parts = [(1, 3, "PROMO", "red bolt", "Brand#2"), (2, 3, "SMALL", "hot rod", "Brand#4"), (3, 4, "STANDARD", "a  b", "Brand#5")]
    lines = [(p, date(y, 5, 1)) for p in (1, 2, 3) for y in (1994, 1995, 1996)]
    spark.createDataFrame(parts, "p_partkey long, p_size int, p_type string, p_name string, p_brand string").write.parquet(f"{tmp_path}/part.parquet")
    spark.createDataFrame(lines, "l_partkey long, l_shipdate date").write.parquet(f"{tmp_path}/lineitem.parquet")
    monkeypatch.setattr(queries, "scratch", lambda s, label: str(tmp_path / label))
    rows = queries.QUERIES["incremental_releases"](spark, str(tmp_path)).collect()
    files = list((tmp_path / "release-files").rglob("part-*"))
    assert files and not [line for f in files for line in f.read_text().splitlines() if line[:1].isspace()]
    assert {(r.year, r.load) for r in rows} == {(1994, 2), (1995, 1), (1996, 2)}
    assert {r.title for r in rows if r.year == 1995 and r.depth == 4} >= {"piece small hot rod brand#4", "standard a  b brand#5"}
    assert {r.title for r in rows if r.year == 1994 and r.depth == 4} >= {"piece small hot rod brand#4 revised"}

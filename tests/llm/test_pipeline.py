"""The pipeline against plain versions of its stages on a small table, and the registered queries."""

import duckdb
import pytest

import __spark_entry__ as entry
import corpus_pipeline
from codetree.llm import queries
from tests.llm.test_operators import DOCS, SHARED, brute_components, prose

SF = "/root/testdata/sf0.001"


def test_stages(spark, tmp_path):
    queries.ready(spark)
    items = [r["text"] for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    clean = {k: prose(100 + k, 120) for k in range(1, 9)}
    near = clean[1].split()
    near[3] = "edited"
    rows = clean | {
        20: clean[2], 21: " ".join(near), 22: f"{prose(200, 60)} {SHARED} {prose(201, 60)}", 23: f"{prose(202, 60)} {SHARED} {prose(203, 60)}",
        24: f"{prose(204, 80)} {items[0]}", 25: None, 26: "", 27: "12 !!",
    }
    docs = spark.createDataFrame([(k, t, "en", "s", len(t or "")) for k, t in rows.items()], DOCS)
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    spark.read.parquet(f"{SF}/benchmark.parquet").write.parquet(str(tmp_path / "benchmark.parquet"))
    kept, at = [], spark.read.parquet(str(tmp_path / "documents.parquet"))
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, at, str(tmp_path)).write.parquet(str(tmp_path / name))
        at = spark.read.parquet(str(tmp_path / name))
        kept.append({r["doc_id"]: r for r in at.collect()})
        if name != "packing":
            assert at.columns == docs.columns
    assert set(kept[0]) == set(rows) - {25, 26, 27}
    groups = brute_components({k: r["text"] for k, r in kept[0].items()}, 5, 4, 5)
    assert set(kept[1]) == {k for k, (_, c) in groups.items() if k == c} == set(kept[0]) - {20, 21}
    assert kept[2][23]["text"] == f"{prose(202, 60)} {prose(203, 60)}" and SHARED in kept[2][22]["text"]
    assert all(kept[2][k]["text"] == t for k, t in clean.items())
    assert set(kept[3]) == set(kept[2]) - {24}
    assert set(kept[4]) == set(kept[3])
    whole = {(r["doc_id"], r["piece"], r["length"]) for r in corpus_pipeline.run(spark, str(tmp_path)).collect()}
    assert whole == {(r["doc_id"], r["piece"], r["length"]) for r in at.collect()}


def test_stages_on_an_empty_table(spark, tmp_path):
    queries.ready(spark)
    empty = spark.createDataFrame([], DOCS)
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, empty, SF).write.parquet(str(tmp_path / name))
        assert spark.read.parquet(str(tmp_path / name)).count() == 0


@pytest.mark.parametrize("name", sorted(queries.QUERIES))
def test_registered(spark, name):
    found = entry.queries()[name](spark, SF)
    rows = found.collect()
    assert rows
    if name in queries.ORACLE_SQL:
        connection = duckdb.connect()
        connection.sql(f"CREATE VIEW documents AS FROM '{SF}/documents.parquet'")
        want = connection.sql(entry.oracle_sql()[name])
        assert sorted(tuple(r[c] for c in want.columns) for r in rows) == sorted(want.fetchall())


def test_pipeline_is_registered(spark):
    assert entry.queries()["pipeline"] is corpus_pipeline.run and "pipeline" not in entry.oracle_sql()

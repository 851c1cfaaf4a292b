"""Every registered query against its SQL, and the shape of the plans, staged parts included."""

import sys
from collections import Counter

import duckdb
import pytest

import __spark_entry__ as entry
from codetree.plans import oracle
from codetree import staging
from codetree.operators.ordered import fill_down
from codetree.operators.rollup import prefix_rollup
from codetree.plans.queries import QUERIES, THRESHOLD
from codetree.plans.views import TABLES, view
from tests.test_rollup import loop

SF = "/root/testdata/sf0.001"
SQL = oracle.oracle_sql()
KINDS = {"int": "INTEGER", "bigint": "BIGINT", "string": "VARCHAR", "date": "DATE"}


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for t in TABLES:
        connection.sql(f"CREATE VIEW {t} AS FROM '{SF}/{t}.parquet'")
    return connection


def normal(rows, names):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(repr([r[i] for i in order]) for r in rows)


def test_every_query_has_sql():
    assert set(QUERIES) == set(SQL)
    assert set(QUERIES) <= set(entry.queries()) and set(SQL) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name, monkeypatch):
    staged = []

    def noted(df, label, stage=staging.stage):
        staged.append(df._jdf.queryExecution().executedPlan().toString())
        return stage(df, label)

    for module in [m for n, m in sys.modules.items() if n.startswith("codetree.") and hasattr(m, "stage")]:
        monkeypatch.setattr(module, "stage", noted)
    df = QUERIES[name](spark, SF)
    result = duck.sql(SQL[name])
    types = dict(zip(result.columns, map(str, result.types)))
    assert {f.name: KINDS[f.dataType.simpleString()] for f in df.schema} == types
    assert normal(df.collect(), df.columns) == normal(result.fetchall(), result.columns)
    for plan in [*staged, df._jdf.queryExecution().executedPlan().toString()]:
        assert "Python" not in plan and "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_entry_has_rows(spark):
    assert entry.entry(spark).count() > 0


def test_rollup_by_length(spark):
    """Codes resolved per length at sf0.01, against a plain loop over the codes."""
    codes = view(spark, "/root/testdata/sf0.01", "visit_codes")
    fields = [r[0] for r in codes.collect()]
    want = Counter(len(shorten) for shorten, _ in loop(fields, THRESHOLD).values())
    rolled = prefix_rollup(codes, threshold=THRESHOLD).distinct()
    sizes = rolled.selectExpr("length(shorten) AS l").groupBy("l").count().collect()
    assert {r["l"]: r["count"] for r in sizes} == want and len(want) > 2


def test_facts_are_not_shuffled_to_meet_their_groups(spark):
    df = prefix_rollup(view(spark, SF, "visit_codes"), threshold=THRESHOLD)
    plan = df._jdf.queryExecution().sparkPlan().toString()
    assert plan.count("BroadcastHashJoin") >= 1 and "SortMergeJoin" not in plan.split("Scan parquet")[0]


def test_fill_never_sorts_all_rows_in_one_task(spark):
    plan = fill_down(view(spark, SF, "export").select("row", "name"), ["name"], ["row"])
    text = plan._jdf.queryExecution().executedPlan().toString()
    outer = text.split("Union")[0]
    assert "SinglePartition" not in outer


def test_leaf_documents_are_parsed_once(spark, monkeypatch):
    """The query asks for deeper nodes before its rows are read; both read what was parsed."""
    from codetree.plans import queries

    row = (2031, "P01.1", "P01", "p", "P01.1", "q", None, None, None, None, None, None)
    names = ["category", "category_desc", "subcategory_1", "subcategory_1_desc", "subcategory_2", "subcategory_2_desc", "subcategory_3", "subcategory_3_desc", "extension", "extension_desc"]
    leaves = spark.createDataFrame([row], "year int, icd10_code string, " + ", ".join(f"{n} string" for n in names))
    monkeypatch.setattr(queries, "_leaves", lambda spark, d: leaves)
    found = queries.q_xml_nodes(spark, "")
    assert "from_xml" not in found._jdf.queryExecution().optimizedPlan().toString().lower().replace("xmltostructs", "from_xml")
    assert sorted(tuple(r) for r in found.collect()) == [(2031, 1, "P01", "p"), (2031, 2, "P01.1", "q")]

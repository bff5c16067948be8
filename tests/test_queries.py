"""Registered queries: plans without Python, and results beside SQL on the small tables."""

import pytest

from checks import compare, q_sources, registry
from bench import HEADLINE

SF = "/root/testdata/sf0.001"
registry.load()


def test_every_sql_has_a_query():
    assert set(registry.ORACLE) <= set(registry.QUERIES)
    assert set(HEADLINE) <= set(registry.ORACLE)


def test_plans_have_no_python_and_no_cross_join(spark):
    for name in HEADLINE:
        plan = registry.QUERIES[name](spark, SF)._jdf.queryExecution().toString()
        for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "PythonUDF", "EvalPython", "Cross"):
            assert bad not in plan, (name, bad)


def test_scan_reads_only_what_is_asked(spark):
    df = registry.QUERIES["active_sales_strict"](spark, SF)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "l_returnflag" in plan and "PushedFilters: [IsNotNull(l_partkey)]" in plan
    for unused in ("l_tax", "l_discount", "p_brand", "l_linenumber"):
        assert unused not in plan


@pytest.mark.parametrize("name", sorted(HEADLINE))
def test_agrees_with_sql(spark, name):
    message, _, rows = compare.compare(spark, compare.duckdb_tables(SF), name, SF)
    assert message == "" and rows > 0


def test_places_of_a_list_count_through_all_its_documents(spark, monkeypatch):
    """One order for the whole list, as its SQL says, in many documents."""
    monkeypatch.setattr(q_sources, "DOCUMENT", 7)
    name = "load_targets"
    message, _, rows = compare.compare(spark, compare.duckdb_tables(SF), name, SF)
    assert message == "" and rows > 7
    got = [(r["place"], r["address"], r["complex"], r["area_m2"]) for r in registry.QUERIES[name](spark, SF).collect()]
    assert [p for p, *_ in sorted(got)] == list(range(rows))
    entries = [e for _, *e in sorted(got)]
    assert entries == sorted(entries)

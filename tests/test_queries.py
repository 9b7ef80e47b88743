from __future__ import annotations

import pytest
from oracle import connect, difference

from meridian.plans.queries import ORACLES, QUERIES


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_agrees_with_sql(spark, sf, name):
    assert difference(QUERIES[name](spark, sf), connect(sf), ORACLES[name]) is None


def test_plans_use_no_python(spark, sf):
    for name, q in QUERIES.items():
        plan = q(spark, sf)._jdf.queryExecution().executedPlan().toString()
        assert "Python" not in plan and "Arrow" not in plan, name


def test_filters_reach_the_scan(spark, sf):
    plan = QUERIES["prefix_listing"](spark, sf)._jdf.queryExecution().executedPlan().toString()
    assert "StringStartsWith(p_type,S)" in plan and "p_size" not in plan
    plan = QUERIES["dispositions"](spark, sf)._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<o_orderstatus:string>" in plan


def test_entry(spark):
    import __spark_entry__ as e

    assert e.entry(spark).count() > 0
    assert set(e.oracle_sql()) <= set(e.queries())


def test_migration_flows_hold_every_traveller(spark, sf):
    found = {(r.home_place, r.hospital_place): r.n for r in QUERIES["migration_flows"](spark, sf).collect()}
    known = connect(sf).sql("SELECT DISTINCT (120000 + s_nationkey)::VARCHAR FROM supplier JOIN lineitem ON l_suppkey = s_suppkey WHERE s_nationkey <> 7").fetchall()
    assert {a for _, a in found} == {k for (k,) in known} and all(h != a for h, a in found)
    matrix = {(r.home_place, c.removeprefix("to_")): r[c] for r in QUERIES["migration_matrix"](spark, sf).collect() for c in r.asDict() if c != "home_place" and r[c]}
    assert matrix == found


def test_medians(spark):
    import random
    import statistics

    from meridian.operators.relational import medians

    r = random.Random(1)
    for n, accuracy in ((1, 20_000), (2, 20_000), (7, 100), (1001, 100), (4000, 50)):
        rows = [(r.choice([None, r.random(), 0.5]) if n > 2 else r.random(), r.randrange(5)) for _ in range(n)]
        df = spark.createDataFrame(rows, "a double, b int").repartition(3)
        got = medians(df, ["a", "b"], accuracy).first()
        assert got.a == statistics.median([a for a, _ in rows if a is not None]) and got.b == statistics.median([b for _, b in rows])
    assert medians(df.limit(0), ["a"]).first().a is None


def test_diagnosis_is_bound_once(spark, sf):
    plan = QUERIES["cid_normalise"](spark, sf)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("regexp_replace") <= 2

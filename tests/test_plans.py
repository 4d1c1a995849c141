"""Physical-plan checks: every registered query is free of nested-loop and
cartesian joins and of Python UDFs, filters reach the parquet scans, and
the history fill shuffles once."""

import re

import pytest

import __spark_entry__ as E

SF = "/root/testdata/sf0.001"


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def _legs(spark, name):
    """Plans of every leg of a query: of each table it writes on the way, and of its result."""
    from pricebasket.session import watch_cuts

    plans = {}
    with watch_cuts(lambda cut, df: plans.__setitem__(f"{name}/{cut}", _plan(df))):
        plans[name] = _plan(E.queries()[name](spark, SF))
    return plans


@pytest.mark.parametrize("threshold", ["10MB", "-1"])
@pytest.mark.parametrize("name", sorted(E.base_queries()))
def test_no_nested_loop_or_udf(spark, name, threshold):
    """With broadcasts and without, in all legs."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    try:
        for leg, p in _legs(spark, name).items():
            for bad in ("BroadcastNestedLoopJoin", "CartesianProduct", "BatchEvalPython", "ArrowEvalPython"):
                assert bad not in p, f"{leg}: {bad}"
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_filters_and_pruning_reach_scan(spark):
    p = _plan(E.queries()["delete_null_safe"](spark, SF))
    assert "ReadSchema: struct<event_id:bigint,user_id:bigint,event_type:string,value:double>" in p
    p = _plan(E.queries()["rerank_nulls_last"](spark, SF))
    assert "props" not in p
    p = _plan(E.queries()["blocklist_anti"](spark, SF))
    assert "PushedFilters: [IsNotNull(c_acctbal), LessThan(c_acctbal,0.0)" in p


def _depth(line):
    return len(re.match(r"^[\s:|+\-]*", line).group(0))


def _ancestors(lines, i):
    """Ancestor lines of plan line ``i`` (by the tree prefix width)."""
    depth, out = _depth(lines[i]), []
    for line in reversed(lines[:i]):
        d = _depth(line)
        if d < depth:
            out.append(line)
            depth = d
    return out


def _above_generate(plan):
    lines = plan.splitlines()
    gens = [i for i, line in enumerate(lines) if "Generate explode(sequence" in line]
    assert gens
    return [a for i in gens for a in _ancestors(lines, i)]


def test_grid_rows_are_never_shuffled(spark):
    """The days are generated after the last exchange, S28 included, also when
    the selection can't be broadcast; the index has a partial minimum below its
    exchange, and nothing but that crosses it."""
    from pricebasket.operators import history as H
    from pricebasket.operators import index as X
    from pricebasket.operators import selection as S
    from pricebasket.plans import driver_tables as DT

    facts = DT.cut_lineage(DT.price_facts(spark, SF), "px")
    sel = DT.cut_lineage(S.selection_final(S.select_products(facts, DT.MIN_DAYS_USERS, ())), "sel")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for out in (H.densify(facts), H.backfill(facts, DT.EPOCH), H.fill_history(facts, DT.AS_OF, DT.EPOCH),
                    H.fill_and_flag(facts, sel, DT.AS_OF, DT.EPOCH)):
            above = _above_generate(_plan(out))
            assert not any("Exchange" in a or "Sort " in a or "Window" in a for a in above), above
            assert "NestedLoopJoin" not in _plan(out)
        full = H.fill_and_flag(facts, sel, DT.AS_OF, DT.EPOCH)
        above = _above_generate(_plan(X.weighted_index(full, DT.AS_OF)))
        first = next(i for i, a in enumerate(above) if "Exchange" in a)
        assert any("HashAggregate" in a and "partial_min" in a for a in above[:first])
        above = _above_generate(_plan(X.rollup_all_levels(full)))
        first = next(i for i, a in enumerate(above) if "Exchange" in a)
        assert not any("Expand" in a for a in above[:first])
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")

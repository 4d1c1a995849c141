"""What a task hands on grows with the rows it has read, whatever the plan."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from pricebasket.operators import history as H
from pricebasket.operators import identity as I
from pricebasket.operators import index as X
from pricebasket.operators import selection as S
from pricebasket.plans import driver_tables as DT


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def no_broadcast(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


@pytest.fixture
def shuffle_partitions(spark):
    """Sets them; other tests' sessions share this one's settings."""
    was = spark.conf.get("spark.sql.shuffle.partitions")
    yield lambda n: spark.conf.set("spark.sql.shuffle.partitions", str(n))
    spark.conf.set("spark.sql.shuffle.partitions", was)


def test_days_of_a_group_take_no_fixed_size(spark):
    """a group's partial state holds the days read, no bitmap of the calendar."""
    d = dt.date(1989, 12, 31)
    f = spark.createDataFrame([("a", d), ("a", d), ("a", None), ("a", dt.date(2101, 1, 1)), ("b", None)], "k string, date date")
    counted = f.groupBy("k").agg(S.distinct_days().alias("n"))
    plan = _plan(counted)
    assert "bitmap" not in plan and plan.count("Exchange") == 1
    assert {r.k: r.n for r in counted.collect()} == {"a": 2, "b": 0}


def test_facts_are_shuffled_as_the_result_takes_them(spark, no_broadcast, tmp_path):
    """the ident's end goes to the taxonomy, not the ident and texts of numbers."""
    spark.createDataFrame([(1, 2, 3, 1, 5.0, 100000.0, 0.06, 0.0, "N", "O", dt.datetime(1997, 1, 2)),
                           (4, 9, 3, 2, 45.0, 50000.0, 0.0, 0.0, "A", "F", dt.datetime(1997, 1, 3))],
                          "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice double, "
                          "l_discount double, l_tax double, l_returnflag string, l_linestatus string, l_shipdate timestamp"
                          ).write.parquet(str(tmp_path / "lineitem.parquet"))
    spark.createDataFrame([(2, "red ring", "Brand#1", "SMALL", 20, 900.0)],
                          "p_partkey long, p_name string, p_brand string, p_type string, p_size int, p_retailprice double"
                          ).write.parquet(str(tmp_path / "part.parquet"))
    out = DT.q_basket_price(spark, str(tmp_path))
    sent = [line for line in _plan(out).splitlines() if "Exchange hashpartitioning" in line]
    assert any("hashpartitioning(__ident#" in line for line in sent) and not any("productId_csuId_ident" in line for line in sent)
    rows = {r.itemId_given_day: r for r in out.collect()}
    assert rows[2].csu_product_id == "P.00000002" and rows[2].basePrice == Decimal("100.00")
    assert rows[2].csuRelevantPrice == Decimal("0.200000") and rows[2].it_product_id_array == "[2]"
    assert rows[9].csu_product_id is None and rows[9].basePrice == Decimal("50.00") and rows[9].country is None


def _facts(spark):
    rows = [("p", name, f"[{i}]", dt.date(2020, 1, d), Decimal(price)) for i, name in ((1, "a"), (2, "b"))
            for d, price in ((1, "2.00"), (3, "2.00"), (6, "1.00"))]
    f = spark.createDataFrame(rows, "csu_product string, itemName string, it_product_id_array string, date date, csuRelevantPrice decimal(24,6)")
    given = {"csu_weight": F.lit(Decimal("0.5")).cast("decimal(18,6)"), "basePrice": F.lit(1)}
    return f.select("*", *[given.get(c, F.lit(None).cast("string")).alias(c)
                           for c in (*H.COALESCED, *H.FACT_ONLY, *H.PRICES) if c not in f.columns])


def test_columns_of_a_run_of_days_are_made_once_a_run(spark):
    """below the days, not on each of them; the index is the same."""
    f, as_of = _facts(spark), dt.date(2020, 1, 7)
    plain = H.fill_history(f, as_of, dt.date(2020, 1, 1))
    packed = H.fill_history(f, as_of, dt.date(2020, 1, 1), per_span=X.with_packed_price)
    lines = X.weighted_index(packed, as_of)._jdf.queryExecution().optimizedPlan().toString().splitlines()
    days = next(i for i, line in enumerate(lines) if "explode(sequence(first_no" in line)
    assert not any("* 10000000000000" in line for line in lines[:days])
    assert any("* 10000000000000" in line for line in lines[days:])
    want = X.weighted_index(plain, as_of).orderBy("date").collect()
    assert [r.vazena_suma for r in want] == [1, 1, Decimal("0.5")]
    assert X.weighted_index(packed, as_of).orderBy("date").collect() == want


def test_runs_of_days_are_shuffled_once(spark, no_broadcast):
    """windows and groups of the runs share one exchange, by a hash."""
    out = H.history_spans(_facts(spark), dt.date(2020, 1, 7), dt.date(2020, 1, 1))
    sent = [line for line in _plan(out).splitlines() if "Exchange hashpartitioning(__hash" in line]
    assert len([line for line in sent if "REPARTITION_BY_COL" in line]) == 1
    assert sum("hashpartitioning(itemName" in line and "filled" in line for line in _plan(out).splitlines()) == 0
    assert sorted((r.itemName, r.n_days) for r in out.collect()) == [("a", 1), ("a", 2), ("b", 1), ("b", 2)]


def _flagged(spark, **kw):
    """Item b changes its product; the selection has it under both, one of them twice, and under no product."""
    f = _facts(spark).withColumn("csu_product", F.when((F.col("itemName") == "b") & (F.col("date") > dt.date(2020, 1, 2)), "q").otherwise("p"))
    rows = [("p", "a", "[1]", 1), ("p", "b", "[2]", 2), ("q", "b", "[2]", 3), ("q", "b", "[2]", 4), (None, "b", "[2]", 5), ("p", "b", None, 6)]
    sel = spark.createDataFrame(rows, "csu_product string, itemName string, it_product_id_array string, order_cheapest int")
    sel = sel.select("*", *[F.lit(None).cast("double").alias(c) for c in H.SELECTION_COLS if c not in sel.columns])
    return H.fill_and_flag(f, sel, dt.date(2020, 1, 7), dt.date(2020, 1, 1), **kw)


FLAGGED = sorted([("a", d, 1) for d in (1, 3, 6)] + [("b", 1, 2)] + [("b", d, o) for d in (3, 6) for o in (3, 4)])


def _found(df):
    assert df.filter("to_include = 0").isEmpty()
    return sorted((r.itemName, r.date.day, r.order_cheapest) for r in df.collect())


def test_settings_that_leave_few_parts_to_aqe(spark, shuffle_partitions):
    shuffle_partitions(200)
    assert H._parts(_facts(spark), H.ITEM_KEYS, 2, 1) is None


def test_points_stay_dealt_and_sorted_for_the_selection(spark, no_broadcast):
    """one exchange and one sort of the points, in which a point's row is there once."""
    out = _flagged(spark)
    plan = _plan(out)
    lines = plan.splitlines()
    depth = [len(line) - len(line.lstrip(" :|+-")) for line in lines]
    window = next(i for i, line in enumerate(lines) if line.lstrip(" :|+-").startswith("Window"))
    above, at = [], depth[window]
    for i in range(window - 1, -1, -1):
        if depth[i] < at:
            above, at = [*above, lines[i]], depth[i]
    assert any("SortMergeJoin" in a for a in above)
    assert not any("Exchange" in a or a.lstrip(" :|+-").startswith("Sort ") for a in above), above
    assert "THEN __row" not in plan
    assert _found(out) == FLAGGED


def test_selection_keyed_by_another_type(spark):
    """Ids as numbers here and as wider ones there are equal, though their hashes are not."""
    f = _facts(spark).withColumn("it_product_id_array", F.substring("it_product_id_array", 2, 1).cast("int"))
    sel = spark.createDataFrame([("p", "a", 1, 7)], "csu_product string, itemName string, it_product_id_array long, order_cheapest int")
    sel = sel.select("*", *[F.lit(None).cast("double").alias(c) for c in H.SELECTION_COLS if c not in sel.columns])
    out = H.fill_and_flag(f, sel, dt.date(2020, 1, 7), dt.date(2020, 1, 1))
    assert sorted((r.itemName, r.order_cheapest) for r in out.collect()) == [("a", 7)] * 3 + [("b", None)] * 3


def test_selection_by_broadcast_has_the_same_rows(spark):
    assert _found(_flagged(spark)) == FLAGGED


@pytest.mark.parametrize("part_rows,parts", [(1, 8), (3, 8), (6, None), (H.PART_ROWS, None)])
def test_parts_go_by_the_days_made(spark, shuffle_partitions, part_rows, parts):
    """six days of two items; few of them are left to AQE."""
    shuffle_partitions(8)
    out = _flagged(spark, part_rows=part_rows)
    assert ("REPARTITION_BY_NUM" in _plan(out)) == (parts is not None)
    assert H._parts(_facts(spark), H.ITEM_KEYS, 2, part_rows) == parts
    assert _found(out) == FLAGGED


def test_more_parts_than_the_shuffle_has(spark, no_broadcast, shuffle_partitions):
    shuffle_partitions(2)
    out = _flagged(spark, part_rows=1)
    assert "hashpartitioning(__hash" in _plan(out) and ", 6), REPARTITION_BY_NUM" in _plan(out)
    assert _found(out) == FLAGGED


def test_no_facts_no_parts(spark, shuffle_partitions):
    shuffle_partitions(8)
    empty = _facts(spark).filter("false")
    assert H._parts(empty, H.ITEM_KEYS, None, 1) is None
    assert H.fill_history(empty, dt.date(2020, 1, 7), dt.date(2020, 1, 1), part_rows=1).collect() == []


def test_barcodes_are_made_of_distinct_images(spark):
    """what is written of the history has no key yet; the keys are the same."""
    hist = spark.createDataFrame([(1, "https://a/b/c/d/X/1.jpg")] * 3 + [(1, "https://a/b/c/d/Y/1.jpg"), (2, "https://a/b/c/d/X/no-image.gif"),
                                 (2, "https://a/b/c/d/X/9.jpg"), (3, None), (None, "https://a/b/c/d/X/1.jpg"), (4, "http://a/b/c/d/Y/1.jpg")],
                                 "itemId long, itemImage string")
    cands = spark.createDataFrame([(1,), (2,)], "productId long")
    made = (I.barcode_from_url("itemImage"), I.valid_image("itemImage"))
    written = []
    got = I.keyed_items(hist, cands, *made, materialize=lambda df: written.append(df) or df, reads=["itemImage"])
    assert [df.columns for df in written] == [["itemId", "itemImage"]]
    assert "split" not in _plan(written[0]) and "HashAggregate" in _plan(written[0]) and written[0].count() == 7
    want = I.keyed_items(hist, cands, *made)
    assert sorted(got.collect(), key=str) == sorted(want.collect(), key=str) and want.count() == 5

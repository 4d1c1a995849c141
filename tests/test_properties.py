"""Properties of SURVEY 5.3 on the generated tables."""

from pyspark.sql import functions as F

import __spark_entry__ as E
from pricebasket.operators import history as H
from pricebasket.operators import index as X
from pricebasket.plans import driver_tables as DT

SF = "/root/testdata/sf0.001"


def test_fill_of_a_complete_grid_changes_nothing(spark):
    """Every (item, day) observed: the fill returns exactly the facts."""
    filled = DT.px_full_history(spark, SF)
    complete = filled.filter(F.col("filled_csuRelevantPrice").isNotNull()).select(
        "itemName", "it_product_id_array", "date", "csu_product",
        F.col("filled_csuRelevantPrice").alias("csuRelevantPrice"))
    # keep only items observed on every day of the grid
    days = complete.select("date").distinct().count()
    full_items = complete.groupBy("itemName", "it_product_id_array").count().filter(F.col("count") == days)
    facts = complete.join(full_items.drop("count"), ["itemName", "it_product_id_array"], "left_semi")
    out = H.fill_history(facts, DT.AS_OF, DT.EPOCH, coalesced=("csu_product",), fact_only=(),
                         prices=("csuRelevantPrice",))
    assert out.filter(F.col("filled") != "original").count() == 0
    got = out.select("itemName", "date", F.col("filled_csuRelevantPrice").alias("p"))
    want = facts.select("itemName", "date", F.col("csuRelevantPrice").alias("p"))
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0


def test_one_cheapest_row_per_product_and_day(spark):
    full = DT.px_full_history(spark, SF)
    cheap = X.cheapest_per_product_day(full, DT.AS_OF)
    assert cheap.groupBy("csu_product", "date").count().filter("count > 1").count() == 0
    keys = full.filter(F.col("filled_csuRelevantPrice").isNotNull() & F.col("csu_product").isNotNull()
                       & (F.col("date") < DT.AS_OF)).select("csu_product", "date").distinct()
    assert cheap.count() == keys.count()


def test_selection_join_keeps_every_history_row(spark):
    """The selection is unique per join key here, so the left join keeps
    the row count of the filled history."""
    facts = DT.price_facts(spark, SF)
    filled = H.fill_history(facts, DT.AS_OF, DT.EPOCH)
    flagged = DT.px_full_history(spark, SF)
    assert flagged.count() == filled.filter(F.col("date") < DT.AS_OF).count()


def test_grid_is_items_times_days(spark):
    f = DT.price_facts(spark, SF)
    filled = E.queries()["fill_forward"](spark, SF)
    items = f.select("itemName", "it_product_id_array").distinct().count()
    days = f.select("date").distinct().count()
    assert filled.count() == items * days

"""Dense history: worked example F10, and random histories against a day-by-day
walk in plain Python."""

import datetime as dt
import random
import time
from decimal import Decimal

import pytest

from pricebasket.operators import history as H

D = dt.date
EPOCH, AS_OF = D(2019, 7, 25), D(2019, 7, 29)
SCHEMA = "itemName string, it_product_id_array string, date date, csu_product string, csuRelevantPrice decimal(18,2)"
COLS = dict(coalesced=("csu_product",), fact_only=(), prices=("csuRelevantPrice",))


def _facts(spark, rows):
    return spark.createDataFrame(
        [(i, f"[{ord(i) if i else 0}]", d, "P" + (i or "-"), None if p is None else Decimal(p))
         for i, d, p in rows], SCHEMA)


def _fill(df, as_of=AS_OF, epoch=EPOCH, **kw):
    return H.fill_history(df, as_of, epoch, **COLS, **kw)


def walk(rows, as_of, epoch):
    """Every item, day by day: (date, item, product, price, end, label)."""
    days = sorted({d for _, d, _ in rows if d})
    out = []
    for item in {i for i, _, _ in rows}:
        seen = {d: p for i, d, p in rows if i == item and d} if item else {}
        marks = sorted(seen.keys() | ({epoch} & set(days) if item else set()))  # days from which something is known
        for day in days:
            before = [m for m in marks if m <= day]
            mark = before[-1] if before else None
            until = min((m for m in marks if mark and m > mark), default=as_of)
            if day in seen:
                price = seen[day]
                out.append((day, item, "P" + item, price, None, "original"))
            elif mark and day < until:
                start = seen[min(seen)] if seen else None
                price = seen.get(mark) if seen.get(mark) is not None or mark != epoch else start
                out.append((day, item, "P" + item if seen else None, price, until, "based_on_previous"))
            else:
                out.append((day, item, None, None, None, "based_on_previous"))
    return sorted(out, key=str)


def got(df):
    return sorted(((r.date, r.itemName, r.csu_product, r.filled_csuRelevantPrice and int(r.filled_csuRelevantPrice),
                    r.filled_end_date, r.filled) for r in df.collect()), key=str)


def histories(seed, n):
    """With NULL keys, undated facts, and start dates in and out of the days that occur."""
    rnd = random.Random(seed)
    for _ in range(n):
        rows = []
        for item in ["A", "B", "C", "D", None][: rnd.randint(1, 5)]:
            days = sorted(rnd.sample(range(20, 32), rnd.randint(1, 6)))
            rows += [(item, D(2019, 7, d), rnd.choice([None, rnd.randint(1, 50)])) for d in days]
            if rnd.random() < 0.3:
                rows.append((item, None, rnd.randint(1, 50)))
        if rnd.random() < 0.3:
            rows.append(("Z", None, 7))  # an item with no dated fact
        yield rows, D(2019, 7, rnd.choice([24, 28, 30, 31])), D(2019, 7, rnd.choice([19, 20, 24, 25, 26]))


def test_fill_worked_example(spark):
    # F10
    rows = [("A", D(2019, 7, 25), 10), ("A", D(2019, 7, 27), 12), ("B", D(2019, 7, 27), 5),
            ("B", D(2019, 7, 28), None), ("C", D(2019, 7, 26), 7), ("D", D(2019, 7, 26), None)]
    out = {(r.itemName, r.date.day): (None if r.filled_csuRelevantPrice is None else int(r.filled_csuRelevantPrice),
                                      r.filled, r.filled_end_date and r.filled_end_date.day)
           for r in _fill(_facts(spark, rows)).collect()}
    f, o = "based_on_previous", "original"
    assert out == {
        ("A", 25): (10, o, None), ("A", 26): (10, f, 27), ("A", 27): (12, o, None), ("A", 28): (12, f, 29),
        ("B", 25): (5, f, 27), ("B", 26): (5, f, 27), ("B", 27): (5, o, None), ("B", 28): (None, o, None),
        ("C", 25): (7, f, 26), ("C", 26): (7, o, None), ("C", 27): (7, f, 29), ("C", 28): (7, f, 29),
        ("D", 25): (None, f, 26), ("D", 26): (None, o, None), ("D", 27): (None, f, 29), ("D", 28): (None, f, 29),
    }


def test_fill_matches_the_walk(spark):
    for rows, as_of, epoch in histories(11, 12):
        assert got(_fill(_facts(spark, rows), as_of, epoch)) == walk(rows, as_of, epoch), (rows, as_of, epoch)


def test_densify_and_backfill(spark):
    for rows, _, epoch in histories(5, 5):
        f = _facts(spark, rows)
        days, items = {d for _, d, _ in rows if d}, {i for i, _, _ in rows}
        cells = {(d, i): p for i, d, p in rows if d and i}
        dense = [(r.grid_date, r.grid_itemName, r.date, r.csuRelevantPrice and int(r.csuRelevantPrice)) for r in H.densify(f).collect()]
        assert sorted(dense, key=str) == sorted(((d, i, d if (d, i) in cells else None, cells.get((d, i))) for d in days for i in items), key=str)
        first = {i: min(((d, p) for j, d, p in rows if j == i and d), default=(None, None))[1] if i else None for i in items}
        back = [(r.grid_date, r.grid_itemName, r.first_csuRelevantPrice and int(r.first_csuRelevantPrice), r.first_date_of_data)
                for r in H.backfill(f, epoch, **COLS).collect()]
        assert sorted(back, key=str) == sorted(((d, i, first[i] if d == epoch and i else None, epoch if d == epoch and i else None)
                                                for d in days for i in items), key=str)


def test_far_date_adds_one_day(spark):
    """A stray date far ahead is one more day, not thousands of years of them."""
    rows = [(i, D(2019, 7, d), d) for i in "ABCDEFGH" for d in range(1, 29)]
    far = [*rows, ("A", D(9019, 1, 1), 1)]
    took = []
    for data in (rows, far, rows, far):
        t = time.perf_counter()
        n = _fill(_facts(spark, data)).count()
        took.append(time.perf_counter() - t)
        assert n == 8 * (28 + (data is far))
    assert took[3] < 3 * took[2] + 2


SEL = ("csu_product string, itemName string, it_product_id_array string, items_in_category long, "
       "days_in_history long, avg_csuRelevantPrice decimal(18,2), min_csuRelevantPrice decimal(38,2), "
       "max_csuRelevantPrice decimal(38,2), mean_coef_var double, order_cheapest int")


def test_flag_on_points(spark):
    """S28 joined to the points: the walk's rows before as_of, once per selection
    row of their product and item, days without a state unflagged."""
    rnd = random.Random(21)
    for rows, as_of, epoch in histories(3, 5):
        chosen = [(i, rnd.randint(1, 99)) for i in "ABC" for _ in range(rnd.choice([0, 1, 2]))]
        sel = spark.createDataFrame([("P" + i, i, f"[{ord(i)}]", 1, 2, Decimal(3), Decimal(1), Decimal(5), 0.5, n)
                                     for i, n in chosen], SEL)
        out = H.fill_and_flag(_facts(spark, rows), sel, as_of, epoch, **COLS)
        want = []
        for r in walk(rows, as_of, epoch):
            if r[0] < as_of:
                hits = [n for i, n in chosen if i == r[1]] if r[2] else []
                want += [(*r, n, 1) for n in hits] or [(*r, None, 0)]
        have = [(r.date, r.itemName, r.csu_product, r.filled_csuRelevantPrice and int(r.filled_csuRelevantPrice), r.filled_end_date,
                 r.filled, r.order_cheapest, r.to_include) for r in out.collect()]
        assert sorted(have, key=str) == sorted(want, key=str)


def test_spans_are_lossless(spark):
    for rows, as_of, epoch in histories(8, 3):
        f = _facts(spark, rows)
        full = _fill(f, as_of, epoch)
        days = sorted({d for _, d, _ in rows if d})
        back = []
        for r in H.spans(full, f).collect():
            own = [d for d in days if r.first_day <= d <= r.last_day]
            assert len(own) == r.n_days
            back += [(d, r.itemName, r.csu_product, r.filled_csuRelevantPrice and int(r.filled_csuRelevantPrice), r.filled_end_date, r.filled)
                     for d in own]
        assert sorted(back, key=str) == got(full)


def _as_rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


@pytest.mark.parametrize("flagged", [False, True])
def test_native_spans_are_those_of_the_history(spark, flagged):
    rnd = random.Random(8)
    for rows, as_of, epoch in histories(3, 17):
        rows = rows + rows[:2] if rnd.random() < 0.4 else rows  # two rows of an item on one day
        f, kw = _facts(spark, rows), dict(COLS)
        if flagged:
            chosen = [(i, rnd.randint(1, 3)) for i in "ABC" for _ in range(rnd.choice([0, 1, 2]))]
            kw["selection"] = spark.createDataFrame(
                [("P" + i, i, f"[{ord(i)}]", 1, 2, Decimal(3), Decimal(1), Decimal(5), 0.5, n) for i, n in chosen], SEL)
        full = H.fill_history(f, as_of, epoch, **kw)
        native = H.history_spans(f, as_of, epoch, **kw)
        want = H.spans(full, f)
        assert native.columns == want.columns and _as_rows(native) == _as_rows(want)
        assert _as_rows(H.expand_spans(H.fill_spans(f, as_of, epoch, **kw), H.days_of(f))) == _as_rows(full)


@pytest.mark.parametrize("rows", [[], [("A", None, 1)]])
def test_no_days(spark, rows):
    assert _fill(_facts(spark, rows)).collect() == [] and H.densify(_facts(spark, rows)).collect() == []

"""The command-line refresh over CSV inputs (string-typed, like scrapes)."""

from pricebasket.__main__ import main
from test_pipeline import D, _inputs


def test_cli_refresh_from_csv(spark, tmp_path):
    src = tmp_path / "in"
    plain = tmp_path / "plain"
    for name, df in _inputs(spark).items():
        df.select(*reversed(df.columns)).write.option("header", True).csv(str(src / name))  # columns in another order
        texts = [c for c, t in df.dtypes if t == "string"]
        df.fillna("", texts).write.parquet(str(plain / name))  # what a CSV file can hold
    out, same = tmp_path / "out", tmp_path / "same"
    main(["--inputs", str(src), "--out", str(out), "--as-of", "2019-08-01", "--format", "csv", "--report"])
    main(["--inputs", str(plain), "--out", str(same), "--as-of", "2019-08-01"])
    for table in sorted(x.name for x in out.iterdir()):
        a, b = (spark.read.parquet(str(x / table)) for x in (out, same))
        assert a.columns == b.columns and a.exceptAll(b).count() == b.exceptAll(a).count() == 0, table
    w = {r.date: float(r.vazena_suma) for r in spark.read.parquet(str(out / "weighted_index")).collect()}
    assert [w[d] for d in D] == [17.5] * 5 + [18.5]
    full = spark.read.parquet(str(out / "full_history"))
    assert full.count() == 12
    # the default rules keep only items with 365 days of history: none here
    assert {r.to_include for r in full.select("to_include").distinct().collect()} == {0}
    # nothing included -> the average tables are empty
    assert spark.read.parquet(str(out / "avg_by_item")).count() == 0

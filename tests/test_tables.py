"""Publishing that never loses the old table, rejected rows, and the cuts folder."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from pricebasket import session
from pricebasket.sources import tables as T
from pricebasket.sources.inputs import (INPUTS, conform, ingest, ingest_inputs, publish, read_csv, rejected_rows,
                                        unparsed_cells)


def rows(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "v int")


def breaking(spark):
    """A table whose write dies half-way: some tasks have written their files."""
    fails = F.when(F.col("id") == 3, F.raise_error(F.lit("killed"))).otherwise(F.col("id"))
    return spark.range(0, 4, 1, 4).select(fails.cast("int").alias("v"))


def values(df):
    return sorted(r.v for r in df.collect())


@pytest.fixture(params=["parquet", "table"])
def place(request, spark, tmp_path):
    if request.param == "parquet":
        yield str(tmp_path / "out"), "parquet"
    else:
        spark.sql("CREATE DATABASE swap_here")
        yield "swap_here", "table"
        spark.sql("DROP DATABASE swap_here CASCADE")


def names(spark, place):
    root, fmt = place
    if fmt == "table":
        return sorted(t.name for t in spark.catalog.listTables(root))
    import os

    return sorted(os.listdir(root))


def test_replace_and_create(spark, place):
    root, fmt = place
    assert values(publish(rows(spark, 1), "t", root, fmt)) == [1]
    assert values(publish(rows(spark, 2, 3), "t", root, fmt)) == [2, 3]
    with pytest.raises(T.TableExists):
        publish(rows(spark, 9), "t", root, fmt, if_exists="error")
    assert values(T.read_published(T.store(spark, root, fmt), "t")) == [2, 3]
    assert values(publish(rows(spark, 5), "u", root, fmt, if_exists="error")) == [5]
    assert names(spark, place) == ["t", "u"]  # nothing else is left


def test_a_killed_write_leaves_the_old_table(spark, place):
    root, fmt = place
    publish(rows(spark, 1, 2), "t", root, fmt)
    with pytest.raises(Exception, match="killed"):
        publish(breaking(spark), "t", root, fmt)
    assert values(T.read_published(T.store(spark, root, fmt), "t")) == [1, 2]
    assert names(spark, place) == ["t"]


@pytest.mark.parametrize("dies_at", [1, 2])
def test_a_run_that_dies_between_the_renames(spark, place, dies_at, monkeypatch):
    """The process ends there: nothing after the failed step runs, no clean-up either."""
    root, fmt = place
    publish(rows(spark, 1, 2), "t", root, fmt)
    to = T.store(spark, root, fmt)
    done = []

    def rename(name, target, real=type(to).rename):
        done.append(name)
        if len(done) == dies_at:
            raise KeyboardInterrupt
        real(to, name, target)

    monkeypatch.setattr(to, "rename", rename)
    monkeypatch.setattr(T, "recover", lambda *a: None)
    monkeypatch.setattr(to, "drop", lambda name: None)
    with pytest.raises(KeyboardInterrupt):
        T.publish_table(to, rows(spark, 7), "t")
    monkeypatch.undo()
    assert values(T.read_published(T.store(spark, root, fmt), "t")) == [1, 2]
    assert values(publish(rows(spark, 8), "t", root, fmt)) == [8]


def test_a_table_that_another_run_created_meanwhile_stays(spark, place, monkeypatch):
    root, fmt = place
    to = T.store(spark, root, fmt)
    write = to.write
    monkeypatch.setattr(to, "write", lambda df, name: (write(df, name), write(rows(spark, 4), "t")))
    with pytest.raises(T.TableExists):
        T.publish_table(to, rows(spark, 7), "t", if_exists="error")
    assert values(spark.table(f"{root}.t") if fmt == "table" else spark.read.parquet(f"{root}/t")) == [4]


RAW = [("1", "2019-07-25", "a"), ("x", "2019-02-31", "b"), ("", None, "c"), (None, "soon", "d"), ("2", " ", "e")]


def raw_history(spark):
    return spark.createDataFrame(RAW, "itemId string, date string, itemName string")


def test_rejects_and_counts_of_one_scan(spark, monkeypatch):
    plans = []
    with session.watch_cuts(lambda name, df: plans.append(df._jdf.queryExecution().executedPlan().toString())):
        got = ingest(raw_history(spark), INPUTS["price_history"], "h")
    assert len(plans) == 1 and plans[0].count("LocalTableScan") + plans[0].count("Scan ") == 1
    assert "CollectMetrics" in plans[0]
    assert got.n_rows == 5 and got.bad_cells == {"itemId": 1, "date": 2}
    assert got.bad_cells == unparsed_cells(raw_history(spark), INPUTS["price_history"]).first().asDict()
    want = conform(raw_history(spark), INPUTS["price_history"])
    assert got.rows.schema == want.schema
    assert sorted(got.rows.collect(), key=str) == sorted(want.collect(), key=str)
    rejected = {json.loads(r.original)["itemName"]: (r.bad_columns, json.loads(r.original)) for r in got.rejects.collect()}
    assert rejected == {"b": (["itemId", "date"], {"itemId": "x", "date": "2019-02-31", "itemName": "b"}),
                        "d": (["date"], {"date": "soon", "itemName": "d"})}
    # the rejected rows are a partition of their own
    assert "rejected" in got.rejects._jdf.queryExecution().executedPlan().toString().split("PartitionFilters: [")[1].split("]")[0]


def test_typed_inputs_are_not_read_again(spark):
    typed = conform(raw_history(spark), INPUTS["price_history"])
    got = ingest(typed, INPUTS["price_history"])
    assert got.n_rows is None and got.bad_cells == {} and got.rejects.count() == 0 and got.rows.count() == 5


def test_rejected_rows_of_all_inputs(spark, tmp_path):
    for name, schema in INPUTS.items():
        raw = spark.createDataFrame([["?"] * len(schema)], ", ".join(f"{f.name} string" for f in schema))
        raw.write.parquet(str(tmp_path / name))
    read = ingest_inputs(spark, {name: str(tmp_path / name) for name in INPUTS})
    got = {r.input: sorted(r.bad_columns) for r in rejected_rows(read).collect()}
    assert got == {"price_history": ["date", "itemId"], "search_hits": ["poradi", "productId"], "product_details": ["itemId"],
                   "taxonomy": ["Vaha", "merna_jednotka"]}


def test_csv_cells_with_line_breaks(spark, tmp_path):
    (tmp_path / "a.csv").write_text('itemId,itemName,date\n1,"a\nb",2019-07-25\n2,"c, ""d""\n\ne",2019-07-26\n')
    got = conform(read_csv(spark, str(tmp_path)), INPUTS["price_history"]).orderBy("itemId").collect()
    assert [(r.itemId, r.itemName.split("\n")[0], r.date) for r in got][0] == (1, "a", dt.date(2019, 7, 25))
    assert len(got) == 2 and got[0].itemName == "a\nb" and got[1].itemName.endswith("\n\ne")
    assert got[1].itemName == 'c, "d"\n\ne'
    (tmp_path / "a.csv").write_text('itemId,itemName\n1,"a \\"b\\" c"\n')
    assert [r.itemName for r in read_csv(spark, str(tmp_path), escape="\\").collect()] == ['a "b" c']
    # files known to hold no line breaks can be split
    (tmp_path / "a.csv").write_text("itemId,itemName\n1,x\n")
    assert [r.itemName for r in read_csv(spark, str(tmp_path), multi_line=False).collect()] == ["x"]


def test_csv_files_of_unlike_headers(spark, tmp_path):
    (tmp_path / "a.csv").write_text("itemId,itemName,date\n1,x,2019-07-25\n")
    (tmp_path / "b.csv").write_text("date,extra,itemId\n2019-07-26,?,2\n")
    (tmp_path / "c.csv").write_text("")
    (tmp_path / "_hidden").write_text("no,table\n")
    got = conform(read_csv(spark, str(tmp_path)), INPUTS["price_history"]).orderBy("itemId").collect()
    assert [(r.itemId, r.itemName, r.date.day) for r in got] == [(1, "x", 25), (2, None, 26)]


class Cluster:
    """A session of a cluster, as far as the cuts folder asks."""

    class Conf(dict):
        def set(self, k, v):
            self[k] = v

    class Context:
        master = "spark://host:7077"
        folder = None

        def getCheckpointDir(self):
            return self.folder

        def setCheckpointDir(self, d):
            self.folder = d

    def __init__(self, **conf):
        self.conf, self.sparkContext = self.Conf(conf), self.Context()


def test_a_cluster_needs_a_shared_folder():
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.ensure_checkpoint_dir(Cluster(**{"spark.sql.warehouse.dir": "file:/w"}))
    named = Cluster(**{"spark.checkpoint.dir": "hdfs:///cuts"})
    assert session.ensure_checkpoint_dir(named) == "hdfs:///cuts" == named.sparkContext.folder


def test_cuts_are_one_folder_and_go(spark):
    path = spark._jvm.org.apache.hadoop.fs.Path(session.cuts_folder(spark))
    files = path.getFileSystem(spark._jsc.hadoopConfiguration())
    cut = session.cut_lineage(rows(spark, 1, 2), "mine")
    assert values(cut) == [1, 2]
    assert any("mine-" in f.getPath().getName() for f in files.listStatus(path))
    assert all(spark.sparkContext.applicationId in f for f in cut.inputFiles())

"""Run the whole refresh: ``python -m pricebasket --inputs DIR --out DIR [--as-of YYYY-MM-DD]``.

``--inputs`` holds one folder (or table, with ``--format table``) per input:
price_history, search_hits, search_results, blocklist, product_details,
taxonomy.  Every published table under ``--out`` is replaced when its new
version is complete, or refused with ``--if-exists error``.
"""

from __future__ import annotations

import argparse
import datetime as dt

from .functions.rules import BasketRules
from .plans.pipeline import run
from .session import get_session, remove_cuts
from .sources.inputs import INPUTS, ingest_inputs, publish, read_inputs, rejected_rows


def main(argv=None) -> None:
    ap = argparse.ArgumentParser(prog="pricebasket", description=__doc__.splitlines()[0])
    ap.add_argument("--inputs", required=True, help="folder (or table prefix) holding the six inputs")
    ap.add_argument("--out", required=True, help="folder for the published tables")
    ap.add_argument("--as-of", default=dt.date.today().isoformat(), help="the run's 'today' (default: today)")
    ap.add_argument("--format", default="parquet", help="parquet, orc, json, csv or table")
    ap.add_argument("--master", default=None, help="Spark master (default: from spark-submit)")
    ap.add_argument("--shuffle-partitions", type=int, default=2000,
                    help="initial shuffle partitions; AQE coalesces them to ~advisory size")
    ap.add_argument("--out-format", default="parquet", help="format of the published tables, or table (--out is a schema)")
    ap.add_argument("--report", action="store_true", help="print the cells that can't be read and barcodes of over two ids")
    ap.add_argument("--rejects", action="store_true", help="also publish rejected_rows: the rows with a cell that can't be read")
    ap.add_argument("--if-exists", default="replace", choices=("replace", "error"), help="what to do with tables of an earlier run")
    ap.add_argument("--checkpoint-dir", default=None,
                    help="folder for intermediate tables that the whole cluster shares (default: spark.checkpoint.dir)")
    a = ap.parse_args(argv)
    extra = {"spark.checkpoint.dir": a.checkpoint_dir} if a.checkpoint_dir else None
    spark = get_session(master=a.master, shuffle_partitions=a.shuffle_partitions, extra=extra)
    sep = "." if a.format == "table" else "/"
    paths = {n: f"{a.inputs.rstrip(sep)}{sep}{n}" for n in INPUTS}

    def write(df, name):
        return publish(df, name, a.out, a.out_format, a.if_exists)

    if a.report or a.rejects:  # one scan gives the typed rows, the rows with bad cells and their counts
        read = ingest_inputs(spark, paths, a.format)
        inputs = {name: x.rows for name, x in read.items()}
        if a.report:
            for name, x in read.items():
                if x.bad_cells:
                    print(name, x.bad_cells)
        if a.rejects:
            write(rejected_rows(read), "rejected_rows")
    else:
        inputs = read_inputs(spark, paths, a.format)
    # each published table is written once and read back by the statements after it
    tables = run(inputs, dt.date.fromisoformat(a.as_of), BasketRules(), published=write)
    if a.report:
        print("barcodes of more than two ids:", tables["crowded_barcodes"].count())
    remove_cuts(spark)


if __name__ == "__main__":
    main()

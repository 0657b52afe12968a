"""Compare every registered query with its SQL equivalent: python -m tests.oracle [sf] [name...]"""

import os
import sys
import tempfile
import time

import duckdb
import pandas as pd
from pyspark.sql import SparkSession

from __spark_entry__ import oracle_sql, queries

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def shape(pdf: pd.DataFrame) -> pd.DataFrame:
    pdf = pdf[sorted(pdf.columns)].copy()
    for c in pdf.columns:
        if pdf[c].dtype.kind == "f":
            pdf[c] = pdf[c].round(6) + 0.0
        pdf[c] = [("" if pd.isna(v) else repr(float(v)) if isinstance(v, (int, float)) and not isinstance(v, bool) else str(v)) for v in pdf[c].astype(object)]
    return pdf.sort_values(list(pdf.columns)).reset_index(drop=True)


def main() -> int:
    sf = sys.argv[1] if len(sys.argv) > 1 else "0.01"
    folder = f"/root/testdata/sf{sf}"
    wanted = sys.argv[2:]
    spark = (
        SparkSession.builder.master(f"local[{os.environ.get('TEST_CPUS', '8')}]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="kinfold-check-"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{folder}/{name}.parquet')")
    sql, bad = oracle_sql(), 0
    for name, run in queries().items():
        if wanted and not any(w in name for w in wanted):
            continue
        start = time.time()
        try:
            mine = run(spark, folder).toPandas()
            took = time.time() - start
            if name not in sql:
                print(f"{name:28} {took:6.2f}s rows {len(mine)}  (rows only)", flush=True)
                continue
            mid = time.time()
            theirs = con.execute(sql[name]).df()
            a, b = shape(mine), shape(theirs)
            same = list(a.columns) == list(b.columns) and a.equals(b)
            print(f"{name:28} {took:6.2f}s sql {time.time() - mid:6.2f}s rows {len(mine)} {'ok' if same else 'DIFFERS'}", flush=True)
            if not same:
                bad += 1
                if list(a.columns) != list(b.columns) or len(a) != len(b):
                    print(list(a.columns), len(a), list(b.columns), len(b))
                else:
                    rows = (a != b).any(axis=1)
                    print(int(rows.sum()), "rows differ\n", a[rows].head(3).to_string()[:900], "\n", b[rows].head(3).to_string()[:900])
        except Exception as e:  # noqa: BLE001
            bad += 1
            print(f"{name:28} FAILED {type(e).__name__}: {str(e)[:700]}", flush=True)
    print("bad:", bad)
    return bad


if __name__ == "__main__":
    sys.exit(main())

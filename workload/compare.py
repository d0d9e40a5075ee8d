"""Run the check queries in both engines and compare the rows: python -m workload.compare [sf_dir] [name ...]."""

import sys
import time

import duckdb

from gridseries.session import build_session
from workload.queries import ORACLES, QUERIES

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events"]


def connect(folder: str):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"create view {name} as select * from '{folder}/{name}.parquet'")
    return con


def differences(got, want) -> str | None:
    if sorted(got.columns) != sorted(want.columns):
        return f"columns {sorted(got.columns)} vs {sorted(want.columns)}"
    if len(got) != len(want):
        return f"{len(got)} rows vs {len(want)}"
    order = sorted(got.columns)
    got = got[order].sort_values(order).reset_index(drop=True)
    want = want[order].sort_values(order).reset_index(drop=True)
    for c in order:
        unequal = ~((got[c] == want[c]) | (got[c].isna() & want[c].isna()))
        if unequal.any():
            i = unequal.idxmax()
            return f"{int(unequal.sum())} values of {c} differ, first {got.loc[i].to_dict()} vs {want.loc[i].to_dict()}"
    return None


def main(folder: str = "/root/testdata/sf0.01", *chosen: str) -> int:
    spark = build_session("compare", "local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.driver.memory": "8g"})
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(folder)
    bad = 0
    for name in chosen or QUERIES:
        began = time.time()
        try:
            got = QUERIES[name](spark, folder).toPandas()
            took = time.time() - began
            if name not in ORACLES:
                print(f"rows  {name} {len(got)} {took:.2f}s", flush=True)
                continue
            problem = differences(got, con.execute(ORACLES[name]).df())
        except Exception as error:
            took, problem = time.time() - began, f"{type(error).__name__}: {str(error)[:900]}"
        bad += problem is not None
        print(f"{'ok   ' if problem is None else 'WRONG'} {name} {len(got) if problem is None else problem} {took:.2f}s",
              flush=True)
    print("wrong:", bad)
    return bad


if __name__ == "__main__":
    sys.exit(main(*sys.argv[1:]) > 0)

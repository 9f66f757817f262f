"""Run a registered query and its DuckDB twin and compare them the way the driver does:
same column names, same row count, same multiset of rows (columns sorted by name)."""

from __future__ import annotations

import math
import sys
import time

import duckdb
import pandas as pd

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None or v is pd.NA or v is pd.NaT:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return v
    if hasattr(v, "item"):
        return _norm(v.item())
    if isinstance(v, pd.Timestamp):
        return v.to_pydatetime().replace(tzinfo=None)
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    if hasattr(v, "tolist"):
        return tuple(_norm(x) for x in v.tolist())
    return v


def rows_of(pdf: pd.DataFrame) -> list[tuple]:
    cols = sorted(pdf.columns)
    out = [tuple(_norm(v) for v in rec) for rec in pdf[cols].itertuples(index=False, name=None)]
    return sorted(out, key=lambda r: tuple((x is None, str(x)) for x in r))


def compare(spark, name: str, sf_dir: str, con=None) -> dict:
    import __spark_entry__ as se

    q = se.queries()[name]
    sql = se.oracle_sql().get(name)
    t0 = time.time()
    sdf = q(spark, sf_dir)
    spdf = sdf.toPandas()
    t1 = time.time()
    res = {"query": name, "spark_rows": len(spdf), "spark_sec": round(t1 - t0, 2)}
    if sql is None:
        res["oracle"] = "none"
        return res
    con = con or duck(sf_dir)
    opdf = con.execute(sql).fetchdf()
    res["oracle_rows"] = len(opdf)
    res["cols_equal"] = sorted(spdf.columns) == sorted(opdf.columns)
    if not res["cols_equal"]:
        res["cols"] = (sorted(spdf.columns), sorted(opdf.columns))
        res["match"] = False
        return res
    st = {c: str(spdf[c].dtype) for c in spdf.columns}
    ot = {c: str(opdf[c].dtype) for c in opdf.columns}
    res["types_equal"] = all(st[c].lower().replace("int", "i").strip("i") == ot[c].lower().replace("int", "i").strip("i")
                             or st[c] == ot[c] for c in st)
    if not res["types_equal"]:
        res["types"] = {c: (st[c], ot[c]) for c in st if st[c] != ot[c]}
    a, b = rows_of(spdf), rows_of(opdf)
    res["match"] = a == b
    if not res["match"] and len(a) == len(b):
        diffs = [(x, y) for x, y in zip(a, b) if x != y]
        res["n_diff"] = len(diffs)
        res["first_diff"] = diffs[:2]
    return res


if __name__ == "__main__":
    sys.path.insert(0, ".")
    from chronoforge import get_spark
    import __spark_entry__ as se

    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or list(se.queries())
    spark = get_spark()
    con = duck(sf)
    bad = 0
    for n in names:
        try:
            r = compare(spark, n, sf, con)
        except Exception as e:  # report and continue
            r = {"query": n, "error": repr(e)[:600]}
        ok = r.get("match", r.get("oracle") == "none")
        bad += not ok
        print(("OK  " if ok else "FAIL"), r, flush=True)
    print("failures:", bad)

"""Run registered queries in Spark and their SQL in DuckDB and compare all rows."""

from __future__ import annotations

import sys
import tempfile
import time

import duckdb

from checks.oracle import TABLES, oracle_statements
from demandspark.config import DemandConfig
from demandspark.plans.queries import CHECK, REGISTRY, run


def database(sf_dir: str) -> "duckdb.DuckDBPyConnection":
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from read_parquet('{sf_dir}/{t}.parquet')")
    return con


def compare(spark, con, sf_dir: str, key: str, sql: str, cfg: DemandConfig | None = None) -> dict:
    """Row counts, column names and types, and rows found on one side only."""
    t0 = time.time()
    df = run(key, spark, sf_dir, cfg if REGISTRY[key][1] is CHECK else None)
    out = tempfile.mkdtemp(prefix="cmp-") + "/out"
    df.write.parquet(out)
    t1 = time.time()
    con.execute(f"create or replace temp table want as {sql}")
    t2 = time.time()
    con.execute(f"create or replace temp view got as select * from read_parquet('{out}/*.parquet')")
    got = {r[0]: r[1] for r in con.execute("describe got").fetchall()}
    want = {r[0]: r[1] for r in con.execute("describe want").fetchall()}
    res = {
        "key": key,
        "spark_s": round(t1 - t0, 1),
        "duck_s": round(t2 - t1, 1),
        "got": con.execute("select count(*) from got").fetchall()[0][0],
        "want": con.execute("select count(*) from want").fetchall()[0][0],
        "columns": len(want),
    }
    if set(got) != set(want):
        return res | {"only_got": sorted(set(got) - set(want)), "only_want": sorted(set(want) - set(got))}
    types = {c: (got[c], want[c]) for c in got if got[c] != want[c]}
    if types:
        res["types"] = types
    cols = ", ".join(f'"{c}"' for c in sorted(want))
    for a, b in (("got", "want"), ("want", "got")):
        n = con.execute(f"select count(*) from (select {cols} from {a} except all select {cols} from {b})").fetchall()[0][0]
        if n:
            res[f"{a}_minus_{b}"] = n
    return res


def explain(con, keys: list[str]) -> dict:
    """Number of differing cells per column, matching rows on ``keys``."""
    cols = [r[0] for r in con.execute("describe want").fetchall() if r[0] not in keys]
    on = " and ".join(f'g."{k}" is not distinct from w."{k}"' for k in keys)
    cells = ", ".join(f'sum(case when g."{c}" is distinct from w."{c}" then 1 else 0 end)' for c in cols)
    row = con.execute(f"select count(*), {cells} from got g join want w on {on}").fetchall()[0]
    return {"joined": row[0], **{c: n for c, n in zip(cols, row[1:]) if n}}


def main(argv: list[str]) -> None:
    from demandspark.session import session

    sf_dir, keys = argv[0], argv[1:]
    spark = session("compare", "local[8]")
    con = database(sf_dir)
    sqls = oracle_statements()
    for key in keys or [k for k in REGISTRY if k in sqls]:
        try:
            res = compare(spark, con, sf_dir, key, sqls[key])
            bad = [k for k in res if "minus" in k or k in ("types", "only_got", "only_want")]
            print("BAD " if bad else "ok  ", res, flush=True)
            if any("minus" in k for k in bad):
                ids = [k for k in ("yj_code", "store_code", "dispensing_date", "patient_no") if k in sqls[key].split(" from ")[0]]
                print("     ", explain(con, ids), flush=True)
        except Exception as e:  # report and go on with the next query
            print("FAIL", key, str(e)[:1500], flush=True)


if __name__ == "__main__":
    main(sys.argv[1:])

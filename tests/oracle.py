"""Run a registered query and its SQL twin and compare whole results."""

from __future__ import annotations

import math
import sys
import time

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def duck(sf_dir: str):
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def cell(v):
    if v is None:
        return "~"
    if isinstance(v, bool):
        return str(v)
    if isinstance(v, float):
        if math.isnan(v):
            return "~"
        return str(int(v)) if v == int(v) and abs(v) < 1e15 else repr(v)
    return f"{type(v).__name__}:{v}" if not isinstance(v, (int, str)) else str(v)


def rows(names, data):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return [names[i] for i in order], sorted(tuple(cell(r[i]) for i in order) for r in data)


def compare(spark, name: str, fn, sql: str | None, sf_dir: str, con=None) -> dict:
    start = time.time()
    df = fn(spark, sf_dir)
    got = df.collect()
    took = time.time() - start
    out = {"name": name, "rows": len(got), "sec": round(took, 2), "ok": True, "sql": bool(sql)}
    odd = [f.dataType.simpleString() for f in df.schema.fields
           if f.dataType.simpleString() not in ("bigint", "int", "double", "string", "boolean")]
    if odd:
        out["odd"] = odd
    plan = df._jdf.queryExecution().executedPlan().toString()
    bad = [n for n in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython") if n in plan]
    if bad:
        out["bad_nodes"] = bad
    if not sql:
        return out
    start = time.time()
    cur = (con or duck(sf_dir)).execute(sql)
    names = [d[0] for d in cur.description]
    want = cur.fetchall()
    out["duck"] = round(time.time() - start, 2)
    types = {d[0]: str(d[1]) for d in cur.description}
    huge = [n for n, t in types.items() if "HUGE" in t or "DECIMAL" in t]
    if huge:
        out["huge"] = huge
    a = rows(df.columns, got)
    b = rows(names, want)
    if a != b:
        out["ok"] = False
        if a[0] != b[0]:
            out["why"] = f"columns {a[0]} vs {b[0]}"
        else:
            extra = [r for r in a[1] if r not in set(b[1])][:3]
            missing = [r for r in b[1] if r not in set(a[1])][:3]
            out["why"] = f"{a[0]} rows {len(a[1])} vs {len(b[1])}\n  spark {extra}\n  duck  {missing}"
    return out


if __name__ == "__main__":
    sys.path.insert(0, ".")
    import __spark_entry__ as entry
    from priorframe.session import local_session

    sf = sys.argv[1]
    wanted = sys.argv[2:]
    spark = local_session("oracle", "8")
    spark.sparkContext.setLogLevel("ERROR")
    con = duck(sf)
    bad = 0
    sqls = entry.oracle_sql()
    for key, fn in entry.queries().items():
        if wanted and not any(key == w or key.startswith(w) for w in wanted):
            continue
        try:
            r = compare(spark, key, fn, sqls.get(key), sf, con)
        except Exception as e:  # noqa: BLE001
            r = {"name": key, "ok": False, "why": f"{type(e).__name__}: {str(e)[:700]}"}
        bad += not r["ok"]
        flag = "ok " if r["ok"] else "BAD"
        warn = " EMPTY" if r.get("rows") == 0 else ""
        print(flag, key, {k: v for k, v in r.items() if k not in ("name", "ok", "why")}, warn,
              r.get("why", ""), flush=True)
    print("bad", bad)

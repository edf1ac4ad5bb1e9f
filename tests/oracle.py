"""Spark query vs DuckDB oracle comparison (row count, column names, values).

Usage: python -m tests.oracle /root/testdata/sf0.01 [--pandas] [name ...]
"""

from __future__ import annotations

import datetime as dt
import decimal
import sys
import time

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def duck(sf_dir: str):
    import duckdb
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


SPARK_TO_DUCK = {"string": "VARCHAR", "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE",
                 "boolean": "BOOLEAN", "timestamp_ntz": "TIMESTAMP", "date": "DATE",
                 "timestamp": "TIMESTAMP WITH TIME ZONE", "float": "FLOAT", "smallint": "SMALLINT"}


def _norm(v):
    if v is None:
        return None
    if isinstance(v, bool):
        return v
    if isinstance(v, float):
        return repr(v)
    if isinstance(v, int):
        return v
    if isinstance(v, decimal.Decimal):
        return repr(float(v))
    if isinstance(v, (dt.datetime, dt.date)):
        return v.isoformat()
    return str(v)


def normalise(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    out = [tuple(_norm(r[i]) for i in order) for r in rows]
    return [cols[i] for i in order], sorted(out, key=repr)


def pandas_canon(df):
    """Order-insensitive text form of a pandas frame (what a pandas-based hasher sees)."""
    df = df[sorted(df.columns)]
    return sorted(tuple(str(v) for v in r) for r in df.itertuples(index=False))


def compare(spark, con, name, builder, sql, sf_dir, pandas_check=False):
    t0 = time.time()
    sdf = builder(spark, sf_dir)
    srows = [tuple(r) for r in sdf.collect()]
    t1 = time.time()
    scols = sdf.columns
    if sql is None:
        return {"name": name, "ok": None, "rows": len(srows), "spark_s": round(t1 - t0, 2)}
    res = con.execute(sql)
    dcols = [d[0] for d in res.description]
    drows = res.fetchall()
    sc, sn = normalise(scols, srows)
    dc, dn = normalise(dcols, drows)
    ok = sc == dc and sn == dn
    info = {"name": name, "ok": ok, "rows": len(srows), "oracle_rows": len(drows),
            "spark_s": round(t1 - t0, 2)}
    if pandas_check:
        info["pandas_ok"] = pandas_canon(sdf.toPandas()) == pandas_canon(con.execute(sql).df())
    stypes = {f.name: SPARK_TO_DUCK.get(f.dataType.simpleString(), f.dataType.simpleString())
              for f in sdf.schema.fields}
    dtypes = {d[0]: str(d[1]) for d in res.description}
    tmis = {c: (stypes[c], dtypes.get(c)) for c in stypes if stypes[c] != dtypes.get(c)}
    if tmis:
        info["type_mismatch"] = tmis
    if not ok:
        if sc != dc:
            info["cols"] = (sc, dc)
        else:
            diff_s = [r for r in sn if r not in set(dn)][:3]
            diff_d = [r for r in dn if r not in set(sn)][:3]
            info["diff"] = (diff_s, diff_d)
    return info


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    pandas_check = "--pandas" in argv[2:]
    names = [a for a in argv[2:] if a != "--pandas"]
    sys.path.insert(0, ".")
    from ledgerline.plans import registry
    from ledgerline.session import build_session
    spark = build_session("local[8]")
    con = duck(sf_dir)
    registry.queries()
    bad = 0
    for name, (fn, sql) in registry.REGISTRY.items():
        if names and name not in names:
            continue
        try:
            info = compare(spark, con, name, fn, sql, sf_dir, pandas_check=pandas_check and sql is not None)
        except Exception as e:  # report and continue
            info = {"name": name, "ok": False, "error": repr(e)[:800]}
        bad += info.get("ok") is False or info.get("pandas_ok") is False
        print(info, flush=True)
    print("FAILED" if bad else "ALL OK", bad)


if __name__ == "__main__":
    main(sys.argv)

"""Run registered queries next to their SQL: ``python -m tests.oracle SF_DIR [name ...]``."""

from __future__ import annotations

import math
import sys
import time

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def connect(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def cell(v):
    if v is None:
        return None
    if isinstance(v, bool):
        return v
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 9) + 0.0
    if hasattr(v, "as_tuple"):
        return round(float(v), 9)
    return v


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted([tuple(cell(r[i]) for i in order) for r in rows], key=lambda r: tuple((x is None, str(type(x)), x) if x is not None else (True, "", 0) for x in r))


def spark_rows(df):
    return sorted(df.columns), rows_of(df.columns, [tuple(r) for r in df.collect()])


def duck_rows(con, sql):
    cur = con.execute(sql)
    columns = [c[0] for c in cur.description]
    return sorted(columns), rows_of(columns, cur.fetchall())


def compare(spark, con, sf_dir, fn, sql):
    """None if equal, else what differs."""
    sc, sr = spark_rows(fn(spark, sf_dir))
    dc, dr = duck_rows(con, sql)
    if sc != dc:
        return f"columns {sc} / {dc}"
    if len(sr) != len(dr):
        return f"rows {len(sr)} / {len(dr)}"
    for a, b in zip(sr, dr):
        if a != b or [type(x) for x in a] != [type(x) for x in b]:
            return f"first difference\n   spark {str(a)[:600]}\n   duck  {str(b)[:600]}"
    return None


if __name__ == "__main__":
    from __spark_entry__ import oracle_sql, queries
    from tutelage.session import local_session

    spark = local_session(8)
    spark.sparkContext.setLogLevel("ERROR")
    sf_dir, names = sys.argv[1], sys.argv[2:]
    qs, sqls = queries(), oracle_sql()
    con = connect(sf_dir)
    bad = []
    for name, fn in qs.items():
        if names and not any(name.startswith(n) for n in names):
            continue
        t = time.time()
        try:
            if name in sqls:
                diff = compare(spark, con, sf_dir, fn, sqls[name])
                verdict = "ok" if diff is None else "DIFF " + diff
            else:
                verdict = f"rows only {len(fn(spark, sf_dir).collect())}"
        except Exception as e:  # noqa: BLE001
            verdict = "ERROR " + str(e)[:1500]
        if verdict.startswith(("DIFF", "ERROR")):
            bad.append(name)
        print(f"{name:28s} {time.time() - t:6.2f}s  {verdict}", flush=True)
    print("bad:", bad)

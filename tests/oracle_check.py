"""Compare registered queries with their SQL: python tests/oracle_check.py SF_DIR [name ...]"""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


def canonical(rows, columns):
    order = sorted(range(len(columns)), key=lambda i: columns[i])

    def norm(v):
        if v is None or (isinstance(v, float) and math.isnan(v)):
            return ""
        if isinstance(v, bool):
            return str(v)
        if isinstance(v, float):
            return f"{v:.6f}"
        if hasattr(v, "isoformat"):
            return v.isoformat()
        return str(v)

    return sorted(tuple(norm(r[i]) for i in order) for r in rows)


def connect(sf_dir):
    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def compare(spark, con, sf_dir, fn, sql):
    df = fn(spark, sf_dir)
    got = canonical([tuple(r) for r in df.collect()], df.columns)
    if sql is None:
        return None, len(got), ""
    cur = con.execute(sql)
    names = [d[0] for d in cur.description]
    want = canonical(cur.fetchall(), names)
    if sorted(names) != sorted(df.columns):
        return False, len(got), f"columns {sorted(df.columns)} / {sorted(names)}"
    if got != want:
        extra, missing = sorted(set(got) - set(want))[:2], sorted(set(want) - set(got))[:2]
        return False, len(got), f"{len(got)} rows, expected {len(want)}; extra {str(extra)[:300]} missing {str(missing)[:300]}"
    return True, len(got), ""


def main():
    from treeshred import build_session
    import __spark_entry__ as e

    sf_dir, only = sys.argv[1], sys.argv[2:]
    spark = build_session("check", "local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false",
                                                  "spark.driver.memory": "12g", "spark.ui.showConsoleProgress": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    con, bad = connect(sf_dir), []
    oracles = e.oracle_sql()
    for name, fn in e.queries().items():
        if only and name not in only:
            continue
        t = time.time()
        try:
            ok, n, why = compare(spark, con, sf_dir, fn, oracles.get(name))
        except Exception as ex:  # report and go on
            ok, n, why = False, -1, f"{type(ex).__name__}: {str(ex)[:600]}"
        if ok is False:
            bad.append(name)
        print(f"{'rows' if ok is None else 'ok' if ok else 'BAD'} {name} {n} {time.time() - t:.1f}s {why}", flush=True)
    print("bad:", bad)


if __name__ == "__main__":
    main()

"""Run registered queries beside their SQL in DuckDB and compare every value.

    python tests/compare.py [--sf 0.01] [name ...]
"""

from __future__ import annotations

import argparse
import math
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def duck(sf_dir: str):
    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def plain(v):
    """A value both engines agree on the form of; floats keep all their digits."""
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return None
    if isinstance(v, bool):
        return v
    if hasattr(v, "item"):
        v = v.item()
        return plain(v)
    if isinstance(v, float) and math.isfinite(v) and v == int(v):
        return int(v)
    return v


def canonical(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    out = [tuple(plain(r[i]) for i in order) for r in rows]
    return [columns[i] for i in order], sorted(out, key=repr)


def compare(con, sql, df):
    """(same, message)."""
    cols, got = canonical(df.columns, [tuple(r) for r in df.collect()])
    res = con.execute(sql)
    want_cols, want = canonical([d[0] for d in res.description], res.fetchall())
    if cols != want_cols:
        return False, f"columns {cols} != {want_cols}"
    if len(got) != len(want):
        return False, f"{len(got)} rows != {len(want)}: {got[:2]} / {want[:2]}"
    bad = [(g, w) for g, w in zip(got, want) if g != w]
    if bad:
        cells = [(c, x, y) for c, x, y in zip(cols, *bad[0]) if x != y]
        return False, f"{len(bad)} of {len(got)} rows differ, first: {cells[:6]}"
    return True, f"{len(got)} rows"


def local_session():
    from opspark.session import build_session

    spark = build_session("compare", "local[8]", **{
        "spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false", "spark.driver.memory": "12g"})
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def main():
    parser = argparse.ArgumentParser()
    parser.add_argument("--sf", default="0.01")
    parser.add_argument("names", nargs="*")
    args = parser.parse_args()
    from __spark_entry__ import oracle_sql, queries

    sf_dir = f"/root/testdata/sf{args.sf}"
    spark, con, sqls, failed = local_session(), duck(sf_dir), oracle_sql(), 0
    for name, fn in queries().items():
        if args.names and name not in args.names:
            continue
        start = time.time()
        try:
            df = fn(spark, sf_dir)
            if name in sqls:
                same, note = compare(con, sqls[name], df)
            else:
                same, note = True, f"{len(df.collect())} rows (rows only)"
        except Exception as error:  # report every query, then fail at the end
            same, note = False, f"{type(error).__name__}: {str(error)[:600]}"
        spark.catalog.clearCache()
        failed += not same
        print(f"{'ok  ' if same else 'FAIL'} {name:28s} {time.time() - start:6.1f}s  {note}",
              flush=True)
    print(f"{failed} failed")
    sys.exit(failed > 0)


if __name__ == "__main__":
    main()

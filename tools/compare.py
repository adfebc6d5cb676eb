"""Run named queries against their SQL in DuckDB and print the differences.

    python tools/compare.py [--sf DIR] [name ...]
"""

from __future__ import annotations

import argparse
import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402

from meterline.queries import REGISTRY  # noqa: E402
from meterline.session import build_session  # noqa: E402

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def connect(sf_dir: str):
    con = duckdb.connect()
    for name in TABLES:
        path = f"{sf_dir}/{name}.parquet"
        if os.path.exists(path):
            con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


def plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else float(f"{value:.12g}")
    return value


def rows_of(columns: list[str], rows) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    out = [tuple(plain(r[i]) for i in order) for r in rows]
    return sorted(out, key=lambda t: tuple((v is None, str(v)) for v in t))


def compare(spark, con, name: str, sf_dir: str) -> str:
    """Empty text when both sides agree."""
    q = REGISTRY[name]
    df = q.run(spark, sf_dir)
    got = rows_of(df.columns, df.collect())
    if q.sql is None:
        return ""
    res = con.execute(q.sql)
    names = [d[0] for d in res.description]
    kinds = [str(d[1]) for d in res.description]
    want = rows_of(names, res.fetchall())
    if sorted(names) != sorted(df.columns):
        return f"columns {sorted(df.columns)} != {sorted(names)}"
    wide = [f"{n}:{k}" for n, k in zip(names, kinds) if "HUGEINT" in k or "DECIMAL" in k]
    if wide:
        return f"oracle types {wide}"
    if len(got) != len(want):
        return f"rows {len(got)} != {len(want)}"
    bad = [(g, w) for g, w in zip(got, want) if g != w]
    return f"{len(bad)} of {len(got)} rows differ, e.g. {bad[0]}" if bad else ""


def main() -> int:
    parser = argparse.ArgumentParser()
    parser.add_argument("--sf", default="/root/testdata/sf0.01")
    parser.add_argument("names", nargs="*")
    args = parser.parse_args()
    spark = build_session("compare", "local[8]", {"spark.sql.shuffle.partitions": "8", "spark.driver.memory": "8g", "spark.ui.showConsoleProgress": "false"})
    spark.sparkContext.setLogLevel("OFF")
    con = connect(args.sf)
    failed = 0
    for name in args.names or REGISTRY:
        begun = time.time()
        try:
            problem = compare(spark, con, name, args.sf)
        except Exception as exc:  # noqa: BLE001
            problem = f"{type(exc).__name__}: {" ".join(str(exc).split())[:400]}"
        failed += bool(problem)
        print(f"{'FAIL' if problem else 'ok  '} {name} {time.time() - begun:.1f}s {problem}", flush=True)
    print(f"{failed} failed")
    return 1 if failed else 0


if __name__ == "__main__":
    sys.exit(main())

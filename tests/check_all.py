"""Run every registered query against its DuckDB oracle.

usage: python tests/check_all.py [sf_dir] [name ...]"""

from __future__ import annotations

import os
import sys
import time
import traceback

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from oracle import compare, duck  # noqa: E402

import __spark_entry__ as E  # noqa: E402
from trustframe.session import get_spark  # noqa: E402


def main():
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    only = set(sys.argv[2:])
    spark = get_spark("local[8]", 8)
    con = duck(sf)
    qs, sqls = E.queries(), E.oracle_sql()
    bad = 0
    for name, fn in qs.items():
        if only and name not in only:
            continue
        t0 = time.time()
        try:
            pdf = fn(spark, sf).toPandas()
        except Exception:
            bad += 1
            print(f"ERROR {name}: spark failed\n{traceback.format_exc()[-1500:]}")
            continue
        ts = time.time() - t0
        if name not in sqls:
            print(f"rows  {name}: {len(pdf)} rows ({ts:.1f}s, no oracle)")
            continue
        try:
            dpdf = con.execute(sqls[name]).df()
        except Exception as e:
            bad += 1
            print(f"ERROR {name}: duckdb failed: {e}")
            continue
        msg = compare(pdf, dpdf)
        if msg:
            bad += 1
            print(f"FAIL  {name}: {msg}")
        else:
            print(f"ok    {name}: {len(pdf)} rows ({ts:.1f}s)")
    print(f"{bad} problems")
    return bad


if __name__ == "__main__":
    sys.exit(1 if main() else 0)

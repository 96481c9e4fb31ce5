"""Run every registered query against its oracle: python tests/run_oracle.py [sf_dir] [names...]"""
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from ledgerlake.session import local_session  # noqa: E402
from tests.oracle import compare, duck  # noqa: E402
import __spark_entry__ as E  # noqa: E402

sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
only = set(sys.argv[2:])
spark = local_session()
spark.sparkContext.setLogLevel("ERROR")
con = duck(sf)
qs, sqls = E.queries(), E.oracle_sql()
bad = 0
for name, fn in qs.items():
    if only and name not in only:
        continue
    t = time.time()
    if name not in sqls:
        n = fn(spark, sf).count()
        print(f"ROWS  {name}: {n} rows ({time.time()-t:.1f}s)", flush=True)
        continue
    try:
        info = compare(spark, con, name, fn, sqls[name], sf)
    except Exception as e:  # noqa: BLE001
        info = {"name": name, "ok": False, "error": repr(e)[:600]}
    bad += not info["ok"]
    print(("OK    " if info["ok"] else "FAIL  ") + f"{name} ({time.time()-t:.1f}s) {info}", flush=True)
print("failures:", bad)

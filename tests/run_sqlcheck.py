"""Checks registered queries against their SQL: run_sqlcheck.py [sf_dir] [name part ...]"""

import os
import sys
import time

sys.path[:0] = [os.path.dirname(os.path.dirname(os.path.abspath(__file__))), os.path.dirname(os.path.abspath(__file__))]

from readloom.plans import registry  # noqa: E402
from readloom.session import build_session  # noqa: E402
from sqlcheck import compare, connect  # noqa: E402

sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
parts = sys.argv[2:]
spark = build_session("sqlcheck", "local[8]", {"spark.sql.shuffle.partitions": "8", "spark.driver.memory": "8g",
                                               "spark.ui.showConsoleProgress": "false"})
spark.sparkContext.setLogLevel("ERROR")
registry.load_all()
con = connect(sf_dir)
bad = 0
for name in registry.QUERIES:
    if parts and not any(p in name for p in parts):
        continue
    start = time.time()
    try:
        problem = compare(spark, con, name, sf_dir)
    except Exception as exc:  # report and go on
        problem = f"{type(exc).__name__}: {str(exc)[:600]}"
    bad += problem is not None
    print(f"{'ok  ' if problem is None else 'BAD '} {name} {time.time() - start:.2f}s"
          f"{'' if name in registry.ORACLE else ' (no SQL)'} {problem or ''}", flush=True)
print("bad:", bad)
sys.exit(bad > 0)

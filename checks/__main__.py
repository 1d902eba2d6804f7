"""``python -m checks [sf_dir] [name ...]``: compare registered queries with their oracles."""

from __future__ import annotations

import sys
import time

from checks import QUERIES
from checks.compare import compare, connect
from tripmart.session import get_session

sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
names = sys.argv[2:] or list(QUERIES)
spark = get_session(master="local[8]", spark__sql__shuffle__partitions="8", spark__driver__memory="8g",
                    spark__ui__showConsoleProgress="false")
spark.sparkContext.setLogLevel("ERROR")
db = connect(sf_dir)
failed = []
for name in names:
    q = QUERIES[name]
    begin = time.time()
    try:
        r = compare(q.run(spark, sf_dir), q.sql, db)
    except Exception as e:  # report and go on with the next query
        r = {"ok": False, "error": str(e)[:1500]}
    took = time.time() - begin
    print(f"{'ok  ' if r['ok'] else 'FAIL'} {name} {took:.2f}s rows={r.get('rows')} {'' if q.sql else '(rows only)'}", flush=True)
    if not r["ok"]:
        failed.append(name)
        print("   ", {k: v for k, v in r.items() if k not in ("ok", "seconds")}, flush=True)
print(f"{len(names) - len(failed)} of {len(names)} ok; failed: {failed}")
sys.exit(bool(failed))

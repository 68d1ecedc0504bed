"""Run registered queries on one scale and print row counts and schemas."""
import sys, time, traceback
sys.path.insert(0, __import__("os").path.dirname(__import__("os").path.dirname(__import__("os").path.abspath(__file__))))
from formsieve.session import get_session
from formsieve.plans.catalog import QUERIES

sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
names = sys.argv[2:] or list(QUERIES)
spark = get_session(master="local[8]", shuffle_partitions=8)
for n in names:
    t = time.time()
    try:
        df = QUERIES[n](spark, sf)
        rows = df.count()
        print(f"OK  {n:20s} rows={rows:7d} {time.time()-t:6.2f}s {df.columns[:12]}", flush=True)
    except Exception as e:
        print(f"ERR {n}: {type(e).__name__}: {str(e)[:600]}", flush=True)

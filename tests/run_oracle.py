"""CLI: compare registered queries with their oracle SQL.

python tests/run_oracle.py [sf_dir] [name ...]
"""
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from oracle import compare  # noqa: E402
from tessera.plans.registry import load_all  # noqa: E402
from tessera.session import build_session  # noqa: E402

base = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
names = sys.argv[2:]
spark = build_session()
Q, S = load_all()
bad = 0
for name in (names or sorted(Q)):
    t0 = time.time()
    if name not in S:
        n = Q[name](spark, base).count()
        print(f"{name:32s} rows-only {n} ({time.time()-t0:.1f}s)")
        continue
    try:
        problems, n = compare(spark, name, Q[name], S[name], base)
    except Exception as e:  # report and continue
        problems, n = [f"error: {type(e).__name__}: {str(e)[:400]}"], -1
    status = "OK " if not problems else "BAD"
    bad += bool(problems)
    print(f"{name:32s} {status} rows={n} ({time.time()-t0:.1f}s) {'; '.join(problems)[:600]}")
print("bad:", bad)

"""Compare queries with their oracle SQL: python check.py [folder] [name or prefix ...]"""

from __future__ import annotations

import sys
import time

from millrace.compare import compare, oracle_connection
from millrace.plans import all_oracles, all_queries
from millrace.session import local_session


def main() -> int:
    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    wanted = sys.argv[2:]
    spark, oracle, bad = local_session(8), oracle_connection(folder), 0
    oracles = all_oracles()
    for name, fn in all_queries().items():
        if wanted and not any(name.startswith(w) for w in wanted):
            continue
        start = time.time()
        try:
            problem = compare(fn(spark, folder), oracle, oracles.get(name))
        except Exception as error:
            problem = f"{type(error).__name__}: {str(error)[:1500]}"
        took = time.time() - start
        bad += problem is not None
        print(f"{'FAIL' if problem else 'ok  '} {name} {took:.1f}s {problem or ''}{'' if name in oracles else ' (rows only)'}", flush=True)
    print(f"{bad} failed")
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main())

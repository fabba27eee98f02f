"""Run registered queries against their DuckDB oracles.

usage: python tests/run_oracles.py [sf_dir] [name-prefix ...]
"""
from __future__ import annotations

import os
import sys
import time
import traceback

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from basketry.oracle.harness import compare, duck_connect  # noqa: E402
from basketry.registry import ORACLES, QUERIES, load_all  # noqa: E402
from basketry.session import build_session  # noqa: E402


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    prefixes = argv[2:]
    load_all()
    spark = build_session(f"local[{os.environ.get('CORES', '8')}]", 8)
    con = duck_connect(sf_dir)
    bad = []
    for name in QUERIES:
        if prefixes and not any(name.startswith(p) for p in prefixes):
            continue
        t0 = time.time()
        try:
            df = QUERIES[name](spark, sf_dir)
            if name in ORACLES:
                ok, msg = compare(df, con, ORACLES[name])
            else:
                n = df.count()
                ok, msg = True, f"{n} rows (no oracle)"
        except Exception as e:  # noqa: BLE001
            ok, msg = False, f"ERROR {type(e).__name__}: {str(e)[:600]}"
            traceback.print_exc(limit=3)
        print(f"{'OK ' if ok else 'BAD'} {name:45s} {time.time() - t0:6.2f}s {msg[:1500]}", flush=True)
        if not ok:
            bad.append(name)
    print(f"\n{len(bad)} failing: {bad}")
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv))

"""Run registered queries against their SQL: ``python tests/check_all.py [sf] [name part ...]``."""

from __future__ import annotations

import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from loanmart.session import local_session  # noqa: E402
from tests.oracle import compare, connect  # noqa: E402


def main() -> int:
    import __spark_entry__ as entry

    sf = sys.argv[1] if len(sys.argv) > 1 else "0.001"
    wanted = sys.argv[2:]
    sf_dir = f"/root/testdata/sf{sf}"
    spark = local_session(cores="8")
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    oracles, bad = entry.oracle_sql(), 0
    for name, fn in entry.queries().items():
        if wanted and not any(w in name for w in wanted):
            continue
        at = time.time()
        try:
            if name in oracles:
                n, faults = compare(spark, con, sf_dir, fn, oracles[name])
            else:
                n, faults = fn(spark, sf_dir).count(), []
        except Exception as e:  # noqa: BLE001
            n, faults = -1, [f"{type(e).__name__}: {str(e)[:1500]}"]
        bad += bool(faults)
        print(f"{'BAD ' if faults else 'ok  '} {name:34s} {n:8d} rows {time.time() - at:6.2f}s"
              f"{'' if name in oracles else '  (no SQL)'}", flush=True)
        for f in faults:
            print("      ", f, flush=True)
    print("bad:", bad)
    return bad


if __name__ == "__main__":
    sys.exit(1 if main() else 0)

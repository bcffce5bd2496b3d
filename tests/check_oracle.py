"""``python tests/check_oracle.py [sf] [name part ...]``: compare queries with their SQL twins."""

import sys
import time
from pathlib import Path

ROOT = Path(__file__).resolve().parent.parent
sys.path[:0] = [str(ROOT), str(ROOT / "tests")]

from oracle import connect, differences  # noqa: E402

from __spark_entry__ import oracle_sql, queries  # noqa: E402
from tidemark import get_session  # noqa: E402


def main() -> int:
    sf, *parts = sys.argv[1:] or ["0.01"]
    sf_dir = f"/root/testdata/sf{sf}"
    spark = get_session("check", "local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.driver.memory": "8g"})
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    twins, bad = oracle_sql(), 0
    for name, run in queries().items():
        if parts and not any(p in name for p in parts):
            continue
        start = time.time()
        try:
            if name in twins:
                found = differences(spark, con, run, twins[name], sf_dir)
            else:
                found = None if run(spark, sf_dir).count() else "no rows"
        except Exception as error:  # noqa: BLE001
            found = f"{type(error).__name__}: {str(error)[:900]}"
        bad += found is not None
        print(f"{'ok  ' if found is None else 'FAIL'} {time.time() - start:6.2f}s {name} {found or ''}", flush=True)
    print(f"{bad} failed")
    return bad


if __name__ == "__main__":
    sys.exit(main())

"""python -m tests.check SF_DIR [query ...]: compare registered queries and print timings."""

from __future__ import annotations

import sys
import time

from terraloom.plans import registered
from terraloom.session import build_session
from tests.compare import connect, differences


def main(sf_dir: str, names: list[str]) -> int:
    spark = build_session("local[8]", 8)
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    entries = registered()
    bad = 0
    for name, (run, sql) in entries.items():
        if names and name not in names:
            continue
        start = time.time()
        try:
            df = run(spark, sf_dir)
            found = differences(df, con, sql) if sql else [f"no sql, {df.count()} rows"]
        except Exception as error:  # report and go on with the next query
            found = [f"{type(error).__name__}: {str(error)[:1500]}"]
        bad += bool(found and sql)
        print(f"{'FAIL' if found and sql else 'ok  '} {name} {time.time() - start:.1f}s", *found, flush=True)
    return bad


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv[1], sys.argv[2:]) else 0)

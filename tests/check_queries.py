"""Run queries against their SQL from the command line: ``python tests/check_queries.py [sf] [name ...]``."""

from __future__ import annotations

import sys
import traceback
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

import __spark_entry__ as entry  # noqa: E402
from docloom.session import build_session  # noqa: E402
from tests.compare import compare, duck  # noqa: E402

if __name__ == "__main__":
    sf = sys.argv[1] if len(sys.argv) > 1 else "0.01"
    names = sys.argv[2:]
    spark = build_session(master="local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.driver.memory": "12g"})
    spark.sparkContext.setLogLevel("ERROR")
    sf_dir = f"/root/testdata/sf{sf}"
    connection = duck(sf_dir)
    bad = 0
    oracle = entry.oracle_sql()
    for name, query in entry.queries().items():
        if names and not any(n in name for n in names):
            continue
        try:
            ok, note = compare(spark, query, oracle.get(name), sf_dir, connection)
        except Exception as error:
            ok, note = False, "".join(traceback.format_exception_only(error))[:1500]
        bad += not ok
        print(("ok   " if ok else "FAIL ") + name + ": " + note, flush=True)
    print("failures:", bad)

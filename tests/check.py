"""Run queries against their oracles: python tests/check.py [sf] [name ...].

BARE=1 uses a session without the library's settings; SKIP is a comma list of names to leave out.
"""

import os
import sys
import time

sys.path.insert(0, ".")

from pyspark.sql import SparkSession  # noqa: E402

from hearthside.session import build_session  # noqa: E402
from tests.oracle import compare, connect  # noqa: E402

if __name__ == "__main__":
    import __spark_entry__ as e

    sf = sys.argv[1] if len(sys.argv) > 1 else "0.01"
    wanted = sys.argv[2:]
    sf_dir = f"/root/testdata/sf{sf}"
    skip = os.environ.get("SKIP", "").split(",")
    if os.environ.get("BARE"):
        spark = SparkSession.builder.master("local[8]").config("spark.driver.memory", "8g").getOrCreate()
    else:
        spark = build_session("check", "local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.driver.memory": "8g"})
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    bad = 0
    for name, fn in e.queries().items():
        if name in skip or wanted and not any(w in name for w in wanted):
            continue
        start = time.time()
        try:
            df = fn(spark, sf_dir)
            sql = e.oracle_sql().get(name)
            result = compare(con, df, sql) if sql else f"rows only: {len(df.collect())}"
        except Exception as error:  # noqa: BLE001
            result = f"ERROR {type(error).__name__}: {str(error)[:600]}"
        ok = result == "" or result.startswith("rows only")
        bad += not ok
        print(f"{'ok ' if ok else 'BAD'} {time.time() - start:6.2f}s {name} {result}", flush=True)
    print("failures:", bad)

"""Command line: compare registered queries with their oracles and time them."""

import sys
import time

sys.path.insert(0, __file__.rsplit("/", 2)[0])

from pyspark.sql import SparkSession

import __spark_entry__ as entry
from tests.compare import difference, duck

if __name__ == "__main__":
    sf = sys.argv[1]
    names = sys.argv[2:]
    spark = (SparkSession.builder.master("local[8]").config("spark.sql.shuffle.partitions", "8")
             .config("spark.ui.enabled", "false").config("spark.driver.memory", "8g").getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    con = duck(sf)
    oracles, bad = entry.oracle_sql(), 0
    for name, run in entry.queries().items():
        if names and name not in names:
            continue
        t = time.time()
        try:
            text = difference(run(spark, sf), con, oracles[name])
        except Exception as e:  # report and go on
            text = f"{type(e).__name__}: {str(e)[:600]}"
        bad += bool(text)
        print(f"{time.time() - t:6.2f}s {name}: {text or 'ok'}", flush=True)
    print("failed:", bad)

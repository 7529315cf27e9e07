"""Run every query next to its oracle: ``python -m checks.verify [sf_dir] [name ...]``."""

import sys
import time
from collections import Counter

import duckdb
from pyspark.sql import SparkSession

from checks.oracles import ORACLES
from checks.queries import QUERIES
from repopulse.session import clean_up

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


def local_session(cores: str = "8") -> SparkSession:
    spark = (SparkSession.builder.master(f"local[{cores}]").appName("repopulse-checks")
             .config("spark.ui.enabled", "false").config("spark.driver.host", "127.0.0.1")
             .config("spark.driver.bindAddress", "127.0.0.1").config("spark.driver.memory", "12g")
             .config("spark.sql.shuffle.partitions", "8").config("spark.sql.session.timeZone", "UTC")
             .getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def connect(sf_dir: str):
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    return con


def rows_of(columns: list[str], rows) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(row[i] for i in order) for row in rows)


def compare(spark, con, sf_dir: str, name: str) -> str:
    df = QUERIES[name](spark, sf_dir)
    got = rows_of(df.columns, df.collect())
    if name not in ORACLES:
        return f"rows-only {sum(got.values())}"
    result = con.execute(ORACLES[name])
    columns = [c[0] for c in result.description]
    if sorted(columns) != sorted(df.columns):
        return f"FAIL columns {sorted(df.columns)} != {sorted(columns)}"
    want = rows_of(columns, result.fetchall())
    if got == want:
        return f"ok {sum(got.values())}"
    only_got, only_want = got - want, want - got
    return (f"FAIL spark {sum(got.values())} oracle {sum(want.values())} differ {sum(only_got.values())}/"
            f"{sum(only_want.values())}\n   columns {sorted(columns)}\n   spark  {str(sorted(only_got, key=str)[:2])[:900]}\n"
            f"   oracle {str(sorted(only_want, key=str)[:2])[:900]}")


def main() -> int:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or list(QUERIES)
    spark, con, failed = local_session(), connect(sf_dir), 0
    for name in names:
        start = time.time()
        try:
            outcome = compare(spark, con, sf_dir, name)
        except Exception as error:  # report and go on with the next query
            outcome = f"FAIL {type(error).__name__}: {str(error)[:600]}"
        failed += outcome.startswith("FAIL")
        print(f"{name:28s} {time.time() - start:6.2f}s {outcome}", flush=True)
    clean_up(spark)
    print(f"{len(names) - failed} of {len(names)} good")
    return 1 if failed else 0


if __name__ == "__main__":
    sys.exit(main())

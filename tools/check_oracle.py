"""Compare registered queries with their SQL on one sample folder.

    python tools/check_oracle.py /root/testdata/sf0.01 [query ...]
"""

from __future__ import annotations

import os
import sys
import time
from pathlib import Path

import duckdb
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from sampleset.compare import differences  # noqa: E402
from sampleset.oracle import ORACLE  # noqa: E402
from sampleset.queries import QUERIES  # noqa: E402


def check(spark: SparkSession, duck: duckdb.DuckDBPyConnection, folder: str, name: str) -> str:
    start = time.time()
    ours = QUERIES[name](spark, folder).toArrow()
    seconds = f"{time.time() - start:6.2f}s"
    if name not in ORACLE:
        return f"rows {ours.num_rows:7d} {seconds}  no SQL"
    found = differences(ours, duck.sql(ORACLE[name]).to_arrow_table())
    return f"rows {ours.num_rows:7d} {seconds}  {'; '.join(found) or 'ok'}"


def main() -> int:
    folder, *names = sys.argv[1:]
    spark = (
        SparkSession.builder.master(f"local[{os.environ.get('BENCH_CPUS', '8')}]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    duck = duckdb.connect()
    for path in sorted(Path(folder).glob("*.parquet")):
        duck.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    failed = []
    for name in names or QUERIES:
        try:
            outcome = check(spark, duck, folder, name)
        except Exception as error:  # noqa: BLE001 - report it and go on with the next query
            outcome = f"ERROR {str(error)[:600]}"
        print(f"{name:36s} {outcome}", flush=True)
        if not outcome.endswith("ok"):
            failed.append(name)
    print(f"{len(failed)} failed: {failed}")
    return 1 if failed else 0


if __name__ == "__main__":
    sys.exit(main())

"""Command-line check: ``python tests/check.py <folder> [name ...]`` compares queries with their oracle SQL."""

import logging
import os
import sys
import time

sys.path[:0] = [os.path.dirname(os.path.dirname(os.path.abspath(__file__))), os.path.dirname(os.path.abspath(__file__))]

from oracle import compare, connect  # noqa: E402

import __spark_entry__ as entry  # noqa: E402
from tidemark.config import build_session  # noqa: E402


def main(folder: str, names: list[str]) -> int:
    spark = build_session("check", "local[8]", **{
        "spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.driver.memory": "8g",
        "spark.ui.showConsoleProgress": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    logging.getLogger("DataFrameQueryContextLogger").disabled = True
    logging.getLogger("SQLQueryContextLogger").disabled = True
    con, queries, sql, failed = connect(folder), entry.queries(), entry.oracle_sql(), 0
    for name in names or queries:
        start = time.time()
        try:
            df = queries[name](spark, folder)
            if name in sql:
                verdict = compare(df, con, sql[name])
            else:
                verdict = f"no oracle, rows {df.count()}"
        except Exception as err:  # report and go on
            verdict = f"ERROR {type(err).__name__}: {str(err)[:600]}"
        failed += verdict is not None and not verdict.startswith("no oracle")
        print(f"{'ok  ' if verdict is None else 'DIFF'} {name} {time.time() - start:.1f}s {verdict or ''}", flush=True)
    print("missing oracle:", sorted(set(queries) - set(sql)), "orphan oracle:", sorted(set(sql) - set(queries)))
    return failed


if __name__ == "__main__":
    sys.exit(main(sys.argv[1], sys.argv[2:]))

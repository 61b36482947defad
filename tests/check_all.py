"""Compare registered queries with their SQL: `python tests/check_all.py <sf folder> [name ...]`."""

import sys
import time
import traceback
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

import __spark_entry__ as entry_point  # noqa: E402
from compare import differences, duck  # noqa: E402
from framequarry.session import build_session  # noqa: E402

if __name__ == "__main__":
    folder, names = sys.argv[1], sys.argv[2:]
    spark = build_session(master="local[8]", spark__sql__shuffle__partitions="8", spark__driver__memory="8g", spark__ui__showConsoleProgress="false")
    spark.sparkContext.setLogLevel("ERROR")
    con, queries, sql = duck(folder), entry_point.queries(), entry_point.oracle_sql()
    bad = 0
    for name, function in queries.items():
        if names and name not in names:
            continue
        start = time.time()
        try:
            if name in sql:
                problem = differences(spark, function, sql[name], folder, con)
                note = "same"
            else:
                problem, note = None, f"{function(spark, folder).count()} rows, no SQL"
        except Exception as error:  # noqa: BLE001
            problem = traceback.format_exc(limit=-2) if names else f"{type(error).__name__}: {str(error)[:600]}"
        bad += problem is not None
        print(f"{name:28s} {time.time() - start:6.2f}s  {problem or note}", flush=True)
    print(f"{bad} of {len(names or queries)} differ")

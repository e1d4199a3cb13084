"""Run registered queries against their SQL twins: check_all.py [folder] [name-prefix ...]."""

import os
import sys
import time
import traceback

sys.path.insert(0, ".")

from tests import compare  # noqa: E402
from tidemark import session  # noqa: E402


def main() -> int:
    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    prefixes = sys.argv[2:]
    import __spark_entry__ as entry

    spark = session.build("check", "local[8]", 8)
    spark.sparkContext.setLogLevel("ERROR")
    connection = compare.connect(os.environ.get("CHECK_DUCK_DIR", folder))
    oracles, failed = entry.oracle_sql(), []
    for name, function in entry.queries().items():
        if prefixes and not any(name.startswith(prefix) for prefix in prefixes):
            continue
        start = time.time()
        try:
            result = compare.spark_rows(function(spark, folder))
            seconds = time.time() - start
            if name in oracles:
                message = compare.difference(result, compare.duck_rows(connection, oracles[name]))
            else:
                message = "" if result[1] else "no rows"
            if not message and not result[1]:
                message = "both empty"
        except Exception as error:
            seconds, message, result = time.time() - start, traceback.format_exc()[-1500:] if prefixes else str(error)[:400], ([], [])
        kind = "sql " if name in oracles else "rows"
        print(f"{'FAIL' if message else 'ok  '} {kind} {name:28s} {len(result[1]):7d} rows {seconds:6.1f}s {message}", flush=True)
        if message:
            failed.append(name)
    print("failed:", failed)
    spark.stop()
    return 1 if failed else 0


if __name__ == "__main__":
    sys.exit(main())

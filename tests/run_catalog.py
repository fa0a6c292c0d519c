"""Compare the whole catalog, or the named queries, at a scale: run_catalog.py <sf_dir> [name ...]"""

from __future__ import annotations

import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tests.oracle import connect, difference  # noqa: E402
from vidstrata.plans.catalog import QUERIES  # noqa: E402
from vidstrata.plans.catalog_sql import SQL  # noqa: E402
from vidstrata.session import build_session  # noqa: E402

if __name__ == "__main__":
    sf_dir, names = sys.argv[1], sys.argv[2:] or list(QUERIES)
    spark = build_session(
        master="local[8]",
        **{"spark.sql.shuffle.partitions": "8", "spark.checkpoint.dir": tempfile.mkdtemp(prefix="catalog-"), "spark.ui.showConsoleProgress": "false"},
    )
    spark.sparkContext.setLogLevel("ERROR")
    connection = connect(sf_dir)
    for name in names:
        started = time.time()
        try:
            if name in SQL:
                found = difference(spark, connection, sf_dir, QUERIES[name], SQL[name])
            else:
                found = f"rows only: {QUERIES[name](spark, sf_dir).count()}"
        except Exception as error:
            found = f"{type(error).__name__}: {str(error)[:600]}"
        print(f"{'OK  ' if found is None else 'DIFF'} {name} {time.time() - started:.1f}s "
              f"{found or ''}", flush=True)

"""Run registered queries against their SQL twins: python tests/check.py SF [names or module:part]."""

from __future__ import annotations

import importlib
import os
import sys
import time
import traceback

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from lodestar.catalog import Catalog, load  # noqa: E402
from lodestar.session import session  # noqa: E402
from tests.oracle import compare, connect  # noqa: E402


def main() -> None:
    sf_dir, picks = f"/root/testdata/sf{sys.argv[1]}", sys.argv[2:]
    chosen = Catalog()
    if not picks:
        chosen = load()
    for pick in picks:
        if pick.startswith("module:"):
            part = importlib.import_module(f"lodestar.catalog.{pick[7:]}").catalog
            chosen.queries.update(part.queries)
            chosen.sql.update(part.sql)
        else:
            everything = load()
            chosen.queries[pick] = everything.queries[pick]
            if pick in everything.sql:
                chosen.sql[pick] = everything.sql[pick]
    spark = session(master="local[8]", spark__sql__shuffle__partitions="8", spark__driver__memory="12g",
                    spark__ui__showConsoleProgress="false")
    spark.sparkContext.setLogLevel("ERROR")
    connection = connect(sf_dir)
    bad = 0
    for name, query in chosen.queries.items():
        started = time.time()
        try:
            if name in chosen.sql:
                problem = compare(spark, connection, query, chosen.sql[name], sf_dir)
                kind = "S"
            else:
                rows = query(spark, sf_dir).collect()
                problem, kind = (None if rows else "no rows"), "R"
                if os.environ.get("SHOW"):
                    for row in rows[:8]:
                        print("    ", row)
        except Exception as error:  # report every query, then go on
            problem, kind = f"{type(error).__name__}: {str(error)[:600]}", "?"
            if os.environ.get("TRACE"):
                traceback.print_exc()
        bad += problem is not None
        print(f"{'ok ' if problem is None else 'BAD'} {kind} {time.time() - started:6.2f}s {name} {problem or ''}", flush=True)
    print(f"{len(chosen.queries)} queries, {bad} bad")
    spark.stop()


if __name__ == "__main__":
    main()

"""Run checked queries on Spark and their SQL on DuckDB, compare rows and types.

usage: python tools/compare.py [--dir DIR] [name prefix ...]
"""

from __future__ import annotations

import argparse
import os
import sys
import time
from collections import Counter

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()
DUCK_TYPES = {"bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE", "boolean": "BOOLEAN",
              "date": "DATE", "float": "FLOAT"}


def connect(directory: str):
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{directory}/{t}.parquet'")
    return con


def compare(con, df, sql: str) -> list[str]:
    """Differences between a Spark frame and a DuckDB result; empty when they agree."""
    problems = []
    columns = sorted(df.columns)
    types = {r[0]: r[1] for r in con.execute(f"DESCRIBE {sql}").fetchall()}
    if sorted(types) != columns:
        return [f"columns {columns} != {sorted(types)}"]
    for field in df.schema.fields:
        want = DUCK_TYPES.get(field.dataType.simpleString())
        if want != types[field.name]:
            problems.append(f"type of {field.name}: {field.dataType.simpleString()} != {types[field.name]}")
    names = ", ".join('"%s"' % c for c in columns)
    theirs = Counter(con.execute(f"SELECT {names} FROM ({sql})").fetchall())
    mine = Counter(tuple(r) for r in df.select(*[f"`{c}`" for c in columns]).collect())
    if mine != theirs:
        only_mine, only_theirs = list((mine - theirs).items()), list((theirs - mine).items())
        problems.append(f"rows {sum(mine.values())} vs {sum(theirs.values())}; only Spark {len(only_mine)} "
                        f"{str(only_mine[:2])[:300]}; only SQL {len(only_theirs)} {str(only_theirs[:2])[:300]}")
    return problems


def main() -> int:
    from mentionflow import checks
    from mentionflow.session import build_session

    parser = argparse.ArgumentParser()
    parser.add_argument("--dir", default="/root/testdata/sf0.01")
    parser.add_argument("names", nargs="*")
    args = parser.parse_args()
    spark = build_session("compare", "local[8]", 8)
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(args.dir)
    sqls, bad = checks.oracle_sql(), 0
    for name, run in checks.queries().items():
        if args.names and not any(name.startswith(p) for p in args.names):
            continue
        begin = time.time()
        try:
            df = run(spark, args.dir)
            problems = compare(con, df, sqls[name]) if name in sqls else ([] if df.count() else ["no rows"])
        except Exception as error:
            problems = [f"{type(error).__name__}: {str(error)[:500]}"]
        bad += bool(problems)
        print(f"{'FAIL' if problems else 'ok  '} {name} {time.time() - begin:.1f}s {' | '.join(problems)}", flush=True)
    print(f"{bad} failed")
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main())

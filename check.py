"""Compare every query with its SQL: names, types, row counts, values.

Usage: python check.py [sf_dir] [query ...]
"""

import datetime
import glob
import os
import sys
import time

import duckdb

from lendmart.plans.queries import ORACLES, QUERIES
from lendmart.session import local_session

TYPES = {"int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "float": "FLOAT",
         "string": "VARCHAR", "date": "DATE", "boolean": "BOOLEAN"}


def connect(sf_dir):
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


def _key(row):
    return tuple((x is None, str(x)) for x in row)


def compare(df, con, sql, tolerance=0.0):
    """List of differences; empty when both sides agree."""
    names = sorted(df.columns)
    relation = con.sql(sql)
    theirs = dict(zip(relation.columns, map(str, relation.types)))
    if names != sorted(theirs):
        return [f"columns {names} != {sorted(theirs)}"]
    problems = [f"type of {n}: {t} != {theirs[n]}" for n, t in df.dtypes
                if TYPES.get(t) != theirs[n]]
    ours = sorted((tuple(r) for r in df.select(*names).collect()), key=_key)
    cols = ", ".join(f'"{n}"' for n in names)
    other = sorted(con.sql(f"SELECT {cols} FROM ({sql})").fetchall(), key=_key)
    if len(ours) != len(other):
        return problems + [f"rows {len(ours)} != {len(other)}"]
    bad = [(a, b) for a, b in zip(ours, other) if a != b]
    problems += [f"{len(bad)} of {len(ours)} rows differ"] * bool(bad)
    for a, b in bad[:3]:
        problems.append(str([(n, x, y) for n, x, y in zip(names, a, b) if x != y]))
    return problems


def main(argv):
    sf_dir = argv[0] if argv else "/root/testdata/sf0.01"
    chosen = argv[1:] or list(QUERIES)
    spark, con, failed = local_session(), connect(sf_dir), []
    for name in chosen:
        start = time.time()
        try:
            df = QUERIES[name](spark, sf_dir)
            if name in ORACLES:
                problems = compare(df, con, ORACLES[name])
            else:
                n = df.count()
                problems = [] if n else ["no rows"]
        except Exception as e:  # report and go on with the next query
            problems = [f"{type(e).__name__}: {str(e)[:1500]}"]
        mark = "ok" if not problems else "FAIL"
        print(f"{name:24s} {mark:5s} {time.time() - start:6.2f}s"
              f"{'' if name in ORACLES else '  (rows only)'}", flush=True)
        for p in problems:
            print("    ", p)
        if problems:
            failed.append(name)
    print(datetime.datetime.now().isoformat(timespec="seconds"),
          f"{len(chosen) - len(failed)}/{len(chosen)} ok", failed)
    return 1 if failed else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))

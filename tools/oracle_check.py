"""Compare catalogue queries with their SQL on one data folder.

usage: python tools/oracle_check.py [folder] [key-prefix ...]
"""

from __future__ import annotations

import datetime
import math
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

import duckdb  # noqa: E402

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
FAMILY = {"int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR", "date": "DATE", "boolean": "BOOLEAN"}


def connect(folder: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{folder}/{t}.parquet')")
    return con


def norm(v):
    if v is None:
        return "~"
    if isinstance(v, bool):
        return str(v)
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return repr(v + 0.0)
    if isinstance(v, (datetime.datetime, datetime.date)):
        return v.isoformat()
    if isinstance(v, (list, tuple)):
        return "[" + ",".join(norm(x) for x in v) + "]"
    if isinstance(v, dict):
        return "{" + ",".join(norm(x) for x in v.values()) + "}"
    return str(v)


def compare(df, rel) -> list[str]:
    problems = []
    cols = sorted(df.columns)
    dcols = sorted(rel.columns)
    if cols != dcols:
        return [f"columns spark={cols} sql={dcols}"]
    stypes = dict(df.dtypes)
    dtypes = dict(zip(rel.columns, [str(t) for t in rel.types]))
    for c in cols:
        if stypes[c] in FAMILY and FAMILY[stypes[c]] != dtypes[c]:
            problems.append(f"type {c}: spark={stypes[c]} sql={dtypes[c]}")
    a = sorted(tuple(norm(r[c]) for c in cols) for r in df.collect())
    idx = [rel.columns.index(c) for c in cols]
    b = sorted(tuple(norm(r[i]) for i in idx) for r in rel.fetchall())
    if len(a) != len(b):
        problems.append(f"rows spark={len(a)} sql={len(b)}")
    diff = [(x, y) for x, y in zip(a, b) if x != y]
    if diff:
        problems.append(f"{len(diff)} rows differ, cols={cols}, first spark={diff[0][0]} sql={diff[0][1]}")
    return problems


def main() -> int:
    from ebbtide.catalog import QUERIES
    from ebbtide.session import get_session

    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    prefixes = tuple(sys.argv[2:])
    spark = get_session("oracle-check", master="local[8]", shuffle_partitions=8)
    con = connect(folder)
    bad = 0
    total = time.time()
    for key, q in QUERIES.items():
        if prefixes and not key.startswith(prefixes):
            continue
        t = time.time()
        try:
            df = q(spark, folder)
            if q.oracle is None:
                n = len(df.collect())
                print(f"rows {key} {n} {time.time() - t:.1f}s", flush=True)
                continue
            problems = compare(df, con.sql(q.oracle))
        except Exception as e:  # report and go on with the next key
            problems = [f"{type(e).__name__}: {str(e)[:1500]}"]
        status = "ok  " if not problems else "BAD "
        bad += bool(problems)
        print(f"{status} {key} {time.time() - t:.1f}s", *problems, sep="\n      " if problems else " ", flush=True)
    print(f"bad={bad} total={time.time() - total:.0f}s of {len(QUERIES)} keys")
    return int(bad > 0)


if __name__ == "__main__":
    sys.exit(main())

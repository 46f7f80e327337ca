"""Compare registered queries with their SQL on DuckDB.

    python tools/check.py [sf folder] [name prefix ...]
"""

from __future__ import annotations

import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402

from quaywork.plans.catalog import ORACLES, QUERIES  # noqa: E402
from quaywork.session import build_session  # noqa: E402

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def value(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return None
    if isinstance(v, bool) or type(v).__name__ == "bool_":
        return bool(v)
    if isinstance(v, (int, float)) or hasattr(v, "as_integer_ratio"):
        return round(float(v), 6)
    return str(v)


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(
        (tuple(value(r[i]) for i in order) for r in rows), key=lambda t: [(x is not None, str(x)) for x in t]
    )


def main() -> int:
    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    prefixes = sys.argv[2:]
    db = duckdb.connect()
    for t in TABLES:
        db.execute(f"CREATE VIEW {t} AS SELECT * FROM '{folder}/{t}.parquet'")
    spark = build_session("check", "local[8]", 8)
    spark.sparkContext.setLogLevel("OFF")
    bad = 0
    for name, run in QUERIES.items():
        if prefixes and not any(name.startswith(p) for p in prefixes):
            continue
        try:
            t0 = time.time()
            df = run(spark, folder)
            mine = [tuple(r) for r in df.collect()]
            spent = time.time() - t0
            if name not in ORACLES:
                print(f"rows {name} {len(mine)} {spent:.2f}s", flush=True)
                continue
            result = db.execute(ORACLES[name])
            columns = [c[0] for c in result.description]
            kinds = {c[0]: str(c[1]) for c in result.description}
            theirs = result.fetchall()
            problems = []
            if sorted(columns) != sorted(df.columns):
                problems.append(f"columns {sorted(df.columns)} vs {sorted(columns)}")
            if any(k in ("DATE", "HUGEINT", "TIMESTAMP") or k.startswith("DECIMAL") for k in kinds.values()):
                print(f"  type note {name}: {kinds}")
            a, b = rows_of(df.columns, mine), rows_of(columns, theirs)
            if a != b:
                extra = [x for x in a if x not in set(b)][:3]
                missing = [x for x in b if x not in set(a)][:3]
                problems.append(f"rows {len(a)} vs {len(b)}; only spark {extra}; only sql {missing}")
            if problems:
                bad += 1
                print(f"BAD  {name}: {' | '.join(problems)[:1500]}", flush=True)
            else:
                print(f"ok   {name} {len(a)} {spent:.2f}s", flush=True)
        except Exception as error:  # report and go on with the next query
            bad += 1
            print(f"FAIL {name}: {type(error).__name__} {str(error)[:700]}", flush=True)
    print(f"{bad} problems")
    return 1 if bad else 0


if __name__ == "__main__":
    raise SystemExit(main())

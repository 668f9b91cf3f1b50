"""Local twin of the driver's correctness gate.

Runs every registered query on Spark and its oracle SQL on DuckDB over the same
parquet tables, then compares column names, row count and an order-insensitive
multiset of rows.  Usage: python scripts/check_oracle.py [sf_dir] [name,name...]
"""

from __future__ import annotations

import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402

from tabforge.plans import registry  # noqa: E402
from tabforge.session import local_session  # noqa: E402

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return "NaN"
        return v + 0.0
    if hasattr(v, "item"):
        return norm(v.item())
    if isinstance(v, (list, tuple)):
        return tuple(norm(x) for x in v)
    return v


def rows_of(cols, records):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    out = [tuple(norm(r[i]) for i in order) for r in records]
    return sorted(out, key=lambda t: tuple((x is None, str(type(x)), str(_coarse(x))) for x in t))


def _coarse(x):
    return round(x, 6) if isinstance(x, float) else tuple(_coarse(y) for y in x) if isinstance(x, tuple) else x


def same(x, y) -> bool:
    """Equal values; floats within 1e-9 of each other, relatively or absolutely."""
    if isinstance(x, tuple) and isinstance(y, tuple):
        return len(x) == len(y) and all(map(same, x, y))
    if isinstance(x, float) and isinstance(y, float):
        return math.isclose(x, y, rel_tol=1e-9, abs_tol=1e-9)
    return x == y


def differences(a, b) -> list:
    """Rows that differ; ``a`` and ``b`` are sorted coarsely, so near ties are matched by search."""
    odd = [(x, y) for x, y in zip(a, b) if not same(x, y)]
    left, right = [x for x, _ in odd], [y for _, y in odd]
    out = []
    for x in left:
        at = next((i for i, y in enumerate(right) if same(x, y)), None)
        if at is None:
            out.append((x, right[0] if right else None))
        else:
            right.pop(at)
    return out


_DUCK_NAMES = {"LongType": "BIGINT", "IntegerType": "INTEGER", "DoubleType": "DOUBLE",
               "StringType": "VARCHAR", "BooleanType": "BOOLEAN", "FloatType": "FLOAT",
               "ShortType": "SMALLINT", "TimestampNTZType": "TIMESTAMP",
               "TimestampType": "TIMESTAMP WITH TIME ZONE", "DateType": "DATE"}


def type_mismatches(sdf, con, sql: str) -> dict:
    """Columns whose Spark type does not map to the DuckDB result type."""
    rel = con.sql(sql)
    duck_t = dict(zip(rel.columns, [str(t) for t in rel.types]))
    out = {}
    for f in sdf.schema.fields:
        want = _DUCK_NAMES.get(type(f.dataType).__name__, str(f.dataType))
        if duck_t.get(f.name) != want:
            out[f.name] = (want, duck_t.get(f.name))
    return out


def compare(spark, con, name: str, fn, sql: str, sf_dir: str) -> str | None:
    """None when Spark and DuckDB agree, else a short reason."""
    sdf = fn(spark, sf_dir)
    bad_types = type_mismatches(sdf, con, sql)
    if bad_types:
        return f"types {bad_types}"
    scols, srows = sdf.columns, [tuple(r) for r in sdf.collect()]
    cur = con.execute(sql)
    dcols, drows = [d[0] for d in cur.description], cur.fetchall()
    if sorted(scols) != sorted(dcols):
        return f"columns {sorted(scols)} vs {sorted(dcols)}"
    a, b = rows_of(scols, srows), rows_of(dcols, drows)
    if len(a) != len(b):
        return f"rows {len(a)} vs {len(b)}"
    diff = differences(a, b)
    if diff:
        return f"values differ, e.g. {diff[:2]}"
    return None


def duck(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        p = f"{sf_dir}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def main():
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    only = set(sys.argv[2].split(",")) if len(sys.argv) > 2 else None
    spark = local_session(8)
    con = duckdb.connect()
    for t in TABLES:
        p = f"{sf_dir}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    qs, ors = registry.queries(), registry.oracle_sql()
    bad = 0
    for name, fn in qs.items():
        if only and name not in only:
            continue
        t0 = time.time()
        try:
            sdf = fn(spark, sf_dir)
            scols = sdf.columns
            srows = [tuple(r) for r in sdf.collect()]
        except Exception as e:  # noqa: BLE001
            print(f"FAIL {name}: spark error {type(e).__name__}: {str(e)[:300]}")
            bad += 1
            continue
        ts = time.time() - t0
        if name not in ors:
            print(f"rows {name}: {len(srows)} rows ({ts:.1f}s), no oracle")
            continue
        try:
            cur = con.execute(ors[name])
            dcols = [d[0] for d in cur.description]
            drows = cur.fetchall()
        except Exception as e:  # noqa: BLE001
            print(f"FAIL {name}: duckdb error {str(e)[:300]}")
            bad += 1
            continue
        if sorted(scols) != sorted(dcols):
            print(f"FAIL {name}: columns {sorted(scols)} vs {sorted(dcols)}")
            bad += 1
            continue
        bad_types = type_mismatches(sdf, con, ors[name])
        if bad_types:
            print(f"FAIL {name}: types {bad_types}")
            bad += 1
            continue
        a, b = rows_of(scols, srows), rows_of(dcols, drows)
        if len(a) != len(b):
            print(f"FAIL {name}: rows {len(a)} vs {len(b)}")
            bad += 1
            continue
        diff = differences(a, b)
        if diff:
            print(f"FAIL {name}: values differ, e.g. {diff[:3]}")
            bad += 1
            continue
        print(f"ok   {name}: {len(a)} rows ({ts:.1f}s)")
    print(f"{bad} failing")


if __name__ == "__main__":
    main()

"""Run registered queries against DuckDB: `python tests/compare.py SF [substring ...]`."""

import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
from ferrolite.plans.registry import TABLES  # noqa: E402

DATA = "/root/testdata/sf{}"


def connect(sf_dir):
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for n in TABLES:
        con.execute(f"CREATE VIEW {n} AS SELECT * FROM '{sf_dir}/{n}.parquet'")
    return con


def _norm(v):
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return f"{v:.9g}" if v else "0"
    if isinstance(v, (list, tuple)):
        return "[" + ",".join(_norm(x) for x in v) + "]"
    if isinstance(v, dict):
        return "{" + ",".join(f"{k}={_norm(x)}" for k, x in sorted(v.items())) + "}"
    if isinstance(v, bool) or v is None:
        return str(v)
    if hasattr(v, "isoformat"):
        return v.replace(tzinfo=None).isoformat() if hasattr(v, "tzinfo") else v.isoformat()
    return f"{type(v).__name__}:{v}"


def rows_of(table):
    cols = sorted(table.column_names)
    data = [table.column(c).to_pylist() for c in cols]
    return cols, sorted(tuple(_norm(v) for v in row) for row in zip(*data)) if data else []


def _type(t):
    s = str(t)
    if s.startswith("timestamp"):
        return "timestamp"
    return s.replace("large_", "").replace("element", "x").replace("l:", "x:").replace("item", "x").replace(" not null", "")


def compare(spark, con, entry, sf_dir):
    got = entry.run(spark, sf_dir).toArrow()
    if entry.sql is None:
        return f"rows={got.num_rows}" if got.num_rows else "EMPTY"
    want = con.execute(entry.sql).to_arrow_table()
    gc, gr = rows_of(got)
    wc, wr = rows_of(want)
    if gc != wc:
        return f"COLUMNS {gc} != {wc}"
    types = [(c, _type(got.schema.field(c).type), _type(want.schema.field(c).type)) for c in gc]
    bad = [t for t in types if t[1] != t[2]]
    if len(gr) != len(wr):
        return f"ROWS {len(gr)} != {len(wr)}; e.g. {gr[:2]} vs {wr[:2]}"
    if gr != wr:
        diff = [(a, b) for a, b in zip(gr, wr) if a != b]
        return f"VALUES {len(diff)} of {len(gr)} differ {gc}: {diff[:2]}"
    if bad:
        return f"TYPES {bad}"
    return f"ok rows={len(gr)}"


if __name__ == "__main__":
    from tests_session import session

    import __spark_entry__  # noqa: F401
    from ferrolite.plans.registry import ENTRIES

    sf_dir = DATA.format(sys.argv[1])
    spark, con, failures = session(), connect(sf_dir), 0
    for name, entry in ENTRIES.items():
        if len(sys.argv) > 2 and not any(a in name or any(i.rstrip("0123456789") == a or i == a for i in entry.items) for a in sys.argv[2:]):
            continue
        start = time.time()
        try:
            res = compare(spark, con, entry, sf_dir)
        except Exception as e:  # noqa: BLE001
            res = f"ERROR {type(e).__name__}: {str(e)[:700]}"
        good = res.startswith(("ok", "rows="))
        failures += not good
        print(f"{'   ' if good else '!! '}{name:32s} {time.time() - start:6.2f}s {'sql' if entry.sql else '   '} {res}", flush=True)
    print("failures:", failures)

"""Run registered queries next to their SQL and report differences.

python tests/compare.py <sf dir> [name or prefix ...]
"""

import math
import os
import sys
import time
import traceback

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tidemill.session import TABLES, build_session  # noqa: E402

TYPES = {
    "BIGINT": "bigint", "INTEGER": "int", "DOUBLE": "double", "VARCHAR": "string", "BOOLEAN": "boolean",
    "TIMESTAMP": "timestamp_ntz", "DATE": "date", "FLOAT": "float",
}


def duck(sf_dir):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _cell(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(v + 0.0)
    return repr(v)


def _rows(rows, names):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(tuple(_cell(r[i]) for i in order) for r in rows)


def differences(df, con, sql):
    """None when the two results are the same, else a short text."""
    rel = con.execute(sql)
    names = [d[0] for d in rel.description]
    kinds = [str(d[1]) for d in rel.description]
    want = rel.fetchall()
    if sorted(names) != sorted(df.columns):
        return f"columns {sorted(df.columns)} want {sorted(names)}"
    types = dict(df.dtypes)
    bad = [(n, types[n], k) for n, k in zip(names, kinds) if types[n] != TYPES.get(k, k)]
    if bad:
        return f"types {bad}"
    got = _rows([tuple(r) for r in df.collect()], df.columns)
    want = _rows(want, names)
    if len(got) != len(want):
        return f"{len(got)} rows, want {len(want)}; got {got[:2]} want {want[:2]}"
    wrong = [(g, w) for g, w in zip(got, want) if g != w]
    return f"{len(wrong)} of {len(got)} rows differ: {wrong[:2]}" if wrong else None


def main():
    import __spark_entry__ as entry

    sf_dir, wanted = sys.argv[1].rstrip("/"), sys.argv[2:]
    spark = build_session(master="local[8]", shuffle_partitions=8)
    spark.sparkContext.setLogLevel("ERROR")
    con, sqls, bad = duck(sf_dir), entry.oracle_sql(), 0
    for name, fn in entry.queries().items():
        if wanted and not any(name == w or (w.endswith("*") and name.startswith(w[:-1])) for w in wanted):
            continue
        t = time.time()
        try:
            df = fn(spark, sf_dir)
            msg = differences(df, con, sqls[name]) if name in sqls else None
            note = "" if name in sqls else f"rows only: {df.count()}"
        except Exception as e:
            msg, note = f"ERROR {type(e).__name__}: {str(e)[:600]}", ""
            if "-v" in os.environ.get("COMPARE", ""):
                traceback.print_exc()
        bad += bool(msg)
        print(f"{'FAIL' if msg else 'ok  '} {name} {time.time() - t:.1f}s {note} {msg or ''}", flush=True)
    print(f"{bad} failures")


if __name__ == "__main__":
    main()

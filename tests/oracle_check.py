"""Run queries next to their oracle SQL and compare the rows.

    python tests/oracle_check.py /root/testdata/sf0.01 [name ...]
"""

from __future__ import annotations

import datetime
import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402

from cellmend.plans import CATALOG  # noqa: E402
from cellmend.plans.catalog import TABLES  # noqa: E402


def _plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else value
    if isinstance(value, datetime.datetime):
        return value.replace(tzinfo=None)
    return value


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    names = [columns[i] for i in order]
    return names, sorted((tuple(_plain(r[i]) for i in order) for r in rows), key=repr)


def connect(sf_dir):
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def difference(spark, con, sf_dir, name, inspect=lambda df: None):
    """None when both sides agree, else what differs; and the Spark row count."""
    entry = CATALOG[name]
    df = entry.run(spark, sf_dir)
    inspect(df)
    got_names, got = _rows(df.columns, [tuple(r) for r in df.collect()])
    if entry.oracle is None:
        return (None if got else "no rows"), len(got)
    cursor = con.execute(entry.oracle)
    want_names, want = _rows([d[0] for d in cursor.description], cursor.fetchall())
    if got_names != want_names:
        return f"columns {got_names} != {want_names}", len(got)
    if len(got) != len(want):
        return f"{len(got)} rows != {len(want)}: {got[:2]} | {want[:2]}", len(got)
    bad = [(g, w) for g, w in zip(got, want) if repr(g) != repr(w)]
    return (f"{len(bad)} rows differ: {bad[:3]}" if bad else None), len(got)


def main():
    from tests.conftest import make_session
    sf_dir, names = sys.argv[1], sys.argv[2:] or list(CATALOG)
    spark, con = make_session(), connect(sf_dir)
    failed = 0
    for name in names:
        start = time.time()
        try:
            problem, count = difference(spark, con, sf_dir, name)
        except Exception as exc:  # report and go on with the next query
            problem, count = f"{type(exc).__name__}: {str(exc)[:1500]}", -1
        failed += problem is not None
        kind = "sql " if CATALOG[name].oracle else "rows"
        print(f"{'FAIL' if problem else 'ok  '} {kind} {name:28s} {count:8d} rows "
              f"{time.time() - start:6.2f}s {problem or ''}", flush=True)
    print(f"{len(names)} queries, {failed} failed")
    sys.exit(bool(failed))


if __name__ == "__main__":
    main()

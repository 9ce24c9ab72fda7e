"""Run queries beside their SQL and compare rows: python tests/oracle_check.py [folder] [name ...]."""

from __future__ import annotations

import datetime
import math
import sys
import time
from collections import Counter
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

import duckdb  # noqa: E402

from ledgerline.plans.inputs import TABLES  # noqa: E402


def plain(value):
    """A value as text that is the same from both engines."""
    if value is None:
        return "<null>"
    if isinstance(value, bool):
        return str(value)
    if isinstance(value, float):
        return repr(value) if math.isnan(value) or value != int(value) else repr(int(value))
    if isinstance(value, datetime.datetime):
        return value.isoformat()
    return str(value)


def rows_of(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(names), Counter(tuple(plain(r[i]) for i in order) for r in rows)


def connect(folder):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{folder}/{t}.parquet'")
    return con


def family(kind: str) -> str:
    """Engine type names reduced to what a comparison depends on."""
    kind = kind.lower()
    for word, name in (("int", "whole"), ("double", "real"), ("float", "real"), ("decimal", "decimal"),
                       ("varchar", "text"), ("string", "text"), ("bool", "bool"), ("date", "date"), ("timestamp", "time")):
        if word in kind:
            return name
    return kind


def compare(spark, con, folder, query, sql):
    """None when both agree, else what differs."""
    df = query(spark, folder)
    names, got = rows_of(df.columns, df.collect())
    result = con.execute(sql)
    described = {d[0]: family(str(d[1])) for d in result.description}
    want_names, want = rows_of([d[0] for d in result.description], result.fetchall())
    if names != want_names:
        return f"columns {sorted(set(names) ^ set(want_names))}"
    types = {f.name: family(f.dataType.simpleString()) for f in df.schema}
    odd = {c: (types[c], described[c]) for c in names if types[c] != described[c]}
    if got != want:
        missing, extra = list((want - got).items())[:2], list((got - want).items())[:2]
        return f"rows {sum(got.values())} vs {sum(want.values())}\n  names {names}\n  sql   {missing}\n  spark {extra}"
    return f"types {odd}" if odd else None


if __name__ == "__main__":
    from ledgerline.plans.oracles import ORACLES
    from ledgerline.plans.queries import QUERIES
    from ledgerline.session import build_session

    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    session = build_session(master="local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false"})
    session.sparkContext.setLogLevel("OFF")
    db = connect(folder)
    wanted = sys.argv[2:] or [q for q in QUERIES if q in ORACLES]
    bad = 0
    for name in wanted:
        start = time.time()
        try:
            problem = compare(session, db, folder, QUERIES[name], ORACLES[name])
        except Exception as error:  # report every query, then fail
            problem = f"{type(error).__name__}: {str(error)[:700]}"
        if problem:
            bad += 1
            print(f"{name}: {problem}"[:1500], flush=True)
        else:
            print(f"{name}: ok {time.time() - start:.1f}s", flush=True)
    print(f"{len(wanted) - bad} of {len(wanted)} agree; without SQL: {sorted(set(QUERIES) - set(ORACLES))}")
    sys.exit(bool(bad))

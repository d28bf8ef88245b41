"""Compare a query with its SQL check: same columns, and the same rows in any order."""

from __future__ import annotations

import math
import os
from collections import Counter

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
)


def connect(sf_dir: str):
    import duckdb

    con = duckdb.connect()
    for name in TABLES:
        path = os.path.join(sf_dir, f"{name}.parquet")
        path = os.path.join(path, "*.parquet") if os.path.isdir(path) else path
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def _value(v):
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 6)
    return v


def differences(df, con, sql: str) -> list[str]:
    """What differs, in words; empty if equal."""
    con.execute("SET python_scan_all_frames = true")  # views over a caller's own frames
    rel = con.execute(sql)
    names = [d[0] for d in rel.description]
    if sorted(names) != sorted(df.columns):
        return [f"columns: {sorted(set(names) ^ set(df.columns))}"]
    order = sorted(names)
    pick = [names.index(n) for n in order]
    want = Counter(tuple(_value(r[i]) for i in pick) for r in rel.fetchall())
    got = Counter(tuple(_value(r[n]) for n in order) for r in df.collect())
    if want == got:
        return []
    out = [f"rows: spark {sum(got.values())}, sql {sum(want.values())}"]
    more, less = list((got - want).elements()), list((want - got).elements())
    out.append(f"only spark {len(more)}, only sql {len(less)}")
    for g, w in zip(sorted(more, key=str)[:400], sorted(less, key=str)[:400]):
        bad = {n: (a, b) for n, a, b in zip(order, g, w) if a != b}
        if len(bad) <= 6:
            out.append(str(bad))
        if len(out) > 8:
            break
    return out

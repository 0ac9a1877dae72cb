"""Compare a registered query with its SQL on DuckDB."""

from __future__ import annotations

import math
import time

from .catalog import ORACLES, QUERIES

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels"
    " conversations"
).split()


def connect(folder: str):
    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{folder}/{t}.parquet')")
    return con


def _kind(values) -> str:
    kinds = {type(v).__name__ for v in values if v is not None}
    return "/".join(sorted(kinds)) or "null"


def _close(a, b) -> bool:
    if isinstance(a, float) and isinstance(b, float):
        return a == b or (math.isnan(a) and math.isnan(b)) or math.isclose(a, b, rel_tol=1e-9, abs_tol=1e-12)
    return a == b


def _key(row):
    return tuple((v is None, "" if v is None else (f"{v:.6g}" if isinstance(v, float) else str(v))) for v in row)


def compare(spark, con, name: str, folder: str) -> dict:
    """Row count, column names, value kinds and values of both sides."""
    started = time.time()
    df = QUERIES[name](spark, folder)
    columns = sorted(df.columns)
    ours = [tuple(r) for r in df.select(*[f"`{c}`" for c in columns]).collect()]
    result = {"name": name, "rows": len(ours), "spark_sec": round(time.time() - started, 2), "problems": []}
    if name not in ORACLES:
        result["oracle"] = False
        return result
    result["oracle"] = True
    started = time.time()
    cursor = con.execute(ORACLES[name])
    names = [d[0] for d in cursor.description]
    theirs = cursor.fetchall()
    result["sql_sec"] = round(time.time() - started, 2)
    if sorted(names) != columns:
        result["problems"].append(f"columns {columns} vs {sorted(names)}")
        return result
    at = [names.index(c) for c in columns]
    theirs = [tuple(r[i] for i in at) for r in theirs]
    if len(ours) != len(theirs):
        result["problems"].append(f"rows {len(ours)} vs {len(theirs)}")
    for i, c in enumerate(columns):
        a, b = _kind(r[i] for r in ours), _kind(r[i] for r in theirs)
        if a != b and "null" not in (a, b):
            result["problems"].append(f"kind of {c}: {a} vs {b}")
    ours.sort(key=_key)
    theirs.sort(key=_key)
    wrong = [(x, y) for x, y in zip(ours, theirs) if not all(_close(p, q) for p, q in zip(x, y))]
    noise = sum(x != y for x, y in zip(ours, theirs)) - len(wrong)
    if wrong:
        result["problems"].append(f"{len(wrong)} rows differ, first {wrong[0]}")
    if noise:
        result["noise"] = noise
    if not ours:
        result["problems"].append("no rows")
    return result


def run(spark, folder: str, only: list[str] | None = None) -> list[dict]:
    con = connect(folder)
    out = []
    for name in only or QUERIES:
        try:
            result = compare(spark, con, name, folder)
        except Exception as error:  # one broken query must not hide the others
            result = {"name": name, "problems": [f"{type(error).__name__}: {str(error)[:600]}"]}
        out.append(result)
        print(result if result["problems"] or result.get("noise") else f"ok {name} {result.get('spark_sec')} {result.get('sql_sec')}", flush=True)
    return out


if __name__ == "__main__":
    import sys

    from ..session import local_session
    from . import load_all

    load_all()
    session = local_session()
    folder = sys.argv[1]
    names = [n for n in QUERIES if any(n.startswith(p) for p in sys.argv[2:])] if len(sys.argv) > 2 else None
    results = run(session, folder, names)
    slow = sorted(results, key=lambda r: -r.get("spark_sec", 0))[:12]
    print("slowest:", [(r["name"], r.get("spark_sec"), r.get("rows")) for r in slow])
    checked = [r for r in results if r.get("oracle")]
    print(f"{len(results)} queries, {len(checked)} with SQL, {sum(bool(r['problems']) for r in results)} with problems")

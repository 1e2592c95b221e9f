"""Run registered queries against their SQL twins: ``python tests/oracle.py [sf_dir] [name ...]``."""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark "
    "labels conversations"
).split()


def duck(sf_dir: str):
    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _plain(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return None
    if hasattr(v, "item"):
        v = v.item()
    return v


def normal(rows: list[tuple], columns: list[str]) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    out = [tuple(_plain(r[i]) for i in order) for r in rows]
    return sorted(out, key=repr)


KINDS = {
    "VARCHAR": "string", "BIGINT": "bigint", "INTEGER": "int", "DOUBLE": "double", "BOOLEAN": "boolean",
}


def compare(spark, con, name: str, sf_dir: str, build, sql: str | None) -> str | None:
    """None when equal, else what differs."""
    df = build(spark, sf_dir)
    got = normal([tuple(r) for r in df.collect()], df.columns)
    if sql is None:
        return None if got else "no rows"
    rel = con.sql(sql)
    want = normal(rel.fetchall(), rel.columns)
    if sorted(df.columns) != sorted(rel.columns):
        return f"columns {sorted(df.columns)} <> {sorted(rel.columns)}"
    types = {c: str(t) for c, t in zip(rel.columns, rel.types)}
    for field in df.schema.fields:
        wanted = KINDS.get(types[field.name], types[field.name])
        if field.dataType.simpleString() != wanted:
            return f"type of {field.name}: {field.dataType.simpleString()} <> {wanted}"
    if len(got) != len(want):
        return f"{len(got)} rows <> {len(want)}"
    if got != want:
        bad = next((a, b) for a, b in zip(got, want) if a != b)
        return f"first difference {str(bad)[:400]}"
    return None if got else "no rows"


def main(argv: list[str]) -> int:
    from __spark_entry__ import oracle_sql, queries

    from crawlprism.session import build_session

    sf_dir = argv[0] if argv else "/root/testdata/sf0.01"
    spark = build_session(master="local[8]", shuffle_partitions=8, extra={"spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    con, sqls, failed = duck(sf_dir), oracle_sql(), 0
    for name, build in queries().items():
        if argv[1:] and name not in argv[1:]:
            continue
        start = time.time()
        try:
            problem = compare(spark, con, name, sf_dir, build, sqls.get(name))
        except Exception as e:  # noqa: BLE001  (report and go on with the next query)
            problem = f"{type(e).__name__}: {str(e)[:600]}"
        kind = "E" if name in sqls else "R"
        print(f"{'ok  ' if problem is None else 'FAIL'} {kind} {name} {time.time() - start:.1f}s {problem or ''}", flush=True)
        failed += problem is not None
    return failed


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))

"""Runs registered queries on Spark and their checks on DuckDB and compares whole results."""

from __future__ import annotations

import datetime as dt
import decimal
import math
import sys
import time

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{sf_dir}/{t}.parquet'")
    return con


def plain(value):
    if isinstance(value, bool) or value is None:
        return value
    if isinstance(value, decimal.Decimal):
        value = float(value)
    if isinstance(value, float):
        if math.isnan(value):
            return "nan"
        return value + 0.0
    if isinstance(value, int):
        return value
    if isinstance(value, dt.datetime):
        return value.replace(tzinfo=None)
    if isinstance(value, list):
        return [plain(v) for v in value]
    return value


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    out = [tuple(repr(plain(r[i])) for i in order) for r in rows]
    return [columns[i] for i in order], sorted(out)


def family(kind: str) -> str:
    kind = kind.lower()
    return {"integer": "int", "varchar": "string", "timestamp_ntz": "timestamp"}.get(kind, kind)


def differences(df, con, sql) -> list[str]:
    got_cols, got = rows_of(df.columns, df.collect())
    rel = con.execute(sql)
    want_cols, want = rows_of([d[0] for d in rel.description], rel.fetchall())
    out = []
    kinds = {d[0]: family(str(d[1])) for d in con.execute(f"describe {sql}").fetchall()}
    mine = {n: family(t) for n, t in df.dtypes}
    if got_cols != want_cols:
        return [f"columns {set(got_cols) ^ set(want_cols)}"]
    for n in got_cols:
        if mine[n] != kinds[n]:
            out.append(f"type {n}: {mine[n]} / {kinds[n]}")
    if len(got) != len(want):
        out.append(f"rows {len(got)} / {len(want)}")
    if got != want:
        a, b = set(got) - set(want), set(want) - set(got)
        out.append(f"{len(a)} / {len(b)} rows differ")
        for x, y in list(zip(sorted(a), sorted(b)))[:3]:
            out += [f"   {n}: {p} / {q}" for n, p, q in zip(got_cols, x, y) if p != q][:6]
    return out


def main(sf_dir: str, names: list[str]) -> int:
    sys.path.insert(0, ".")
    import __spark_entry__ as registry
    from lakeaudit.session import local_session

    spark = local_session("8")
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    queries, oracles = registry.queries(), registry.oracle_sql()
    bad = 0
    for name, query in queries.items():
        if names and not any(n in name for n in names):
            continue
        start = time.time()
        try:
            df = query(spark, sf_dir)
            if name in oracles:
                notes = differences(df, con, oracles[name])
            else:
                notes = []
                print(f"  ({name}: {len(df.collect())} rows, no SQL)")
        except Exception as error:  # noqa: BLE001
            notes = [f"{type(error).__name__}: {str(error)[:700]}"]
        bad += any(not n.startswith("type") for n in notes)
        print(f"{'OK ' if not notes else 'BAD'} {name} {time.time() - start:.2f}s", flush=True)
        for n in notes:
            print("    ", n)
    print("bad:", bad)
    return bad


if __name__ == "__main__":
    sys.exit(main(sys.argv[1], sys.argv[2:]))

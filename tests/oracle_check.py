"""Run registered queries next to their SQL and compare rows exactly."""

from __future__ import annotations

import datetime as dt
import decimal
import sys
import time
from pathlib import Path

import duckdb

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return con


def _plain(value):
    if isinstance(value, decimal.Decimal):
        return format(value, "f")
    if isinstance(value, dt.datetime):
        return value.isoformat(sep=" ")
    if isinstance(value, dt.date):
        return value.isoformat()
    if isinstance(value, float):
        return f"{value:.9g}"
    return value


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    plain = [tuple(_plain(row[i]) for i in order) for row in rows]
    return sorted(columns), sorted(plain, key=lambda row: tuple((v is None, str(v)) for v in row))


_TYPES = {
    "bigint": "BIGINT",
    "int": "INTEGER",
    "string": "VARCHAR",
    "boolean": "BOOLEAN",
    "date": "DATE",
    "timestamp_ntz": "TIMESTAMP",
    "double": "DOUBLE",
}


def compare(df, con, sql: str) -> list[str]:
    """Differences between a Spark frame and a SQL result, empty if they agree."""
    problems = []
    cursor = con.execute(sql)
    names = [d[0] for d in cursor.description]
    theirs = _rows(names, cursor.fetchall())
    described = {row[0]: str(row[1]) for row in con.execute(f"DESCRIBE {sql}").fetchall()}
    ours = _rows(df.columns, [tuple(row) for row in df.collect()])
    if ours[0] != theirs[0]:
        return [f"columns {ours[0]} != {theirs[0]}"]
    for field in df.schema:
        kind = field.dataType.simpleString()
        want = _TYPES.get(kind, kind.upper())
        if described[field.name] != want:
            problems.append(f"type of {field.name}: {kind} vs {described[field.name]}")
    if len(ours[1]) != len(theirs[1]):
        problems.append(f"rows {len(ours[1])} != {len(theirs[1])}")
    if ours[1] != theirs[1]:
        mine, other = set(ours[1]), set(theirs[1])
        problems.append(f"columns {ours[0]}")
        problems.append(f"only here ({len(mine - other)}): {sorted(mine - other, key=str)[:2]}")
        problems.append(f"only in SQL ({len(other - mine)}): {sorted(other - mine, key=str)[:2]}")
    return problems


def main(sf_dir: str, names: list[str]) -> int:
    from tests.conftest import local_session
    from tidemark.plans.catalog import ORACLES, QUERIES

    spark, con, bad = local_session(), duck(sf_dir), 0
    for name in names or list(QUERIES):
        began = time.time()
        try:
            df = QUERIES[name](spark, sf_dir)
            if name in ORACLES:
                problems = compare(df, con, ORACLES[name])
                if not df.limit(1).count():
                    problems.append("EMPTY RESULT")
            else:
                problems = [] if df.count() >= 0 else ["no rows"]
        except Exception as error:  # noqa: BLE001
            problems = [f"{type(error).__name__}: {str(error)[:700]}"]
        bad += bool(problems)
        print(f"{'BAD' if problems else 'ok '} {name} {time.time() - began:.1f}s", flush=True)
        for problem in problems:
            print("     ", problem[:900], flush=True)
    print(f"{bad} of {len(names or QUERIES)} differ")
    return bad


if __name__ == "__main__":
    sys.exit(main(sys.argv[1], sys.argv[2:]))

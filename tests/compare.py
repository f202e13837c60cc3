"""Run registered queries beside their SQL and compare the rows."""

from __future__ import annotations

import datetime
import decimal
import math
import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

import __spark_entry__ as entry  # noqa: E402

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
          "conversations").split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def _plain(value):
    if isinstance(value, decimal.Decimal):
        value = float(value)
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(round(value, 6) + 0.0)
    if isinstance(value, (datetime.date, datetime.datetime)):
        return value.isoformat()
    if isinstance(value, int) and not isinstance(value, bool):
        return repr(value)
    return repr(value)


def _table(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(columns), sorted(tuple(_plain(row[i]) for i in order) for row in rows)


def difference(spark, con, name: str, sf_dir: str) -> tuple[int, str | None]:
    """(rows, None if the query and its SQL agree, else what differs)."""
    df = entry.queries()[name](spark, sf_dir)
    ours = _table(df.columns, [tuple(row) for row in df.collect()])
    cursor = con.execute(entry.oracle_sql()[name])
    theirs = _table([column[0] for column in cursor.description], cursor.fetchall())
    if ours[0] != theirs[0]:
        return len(ours[1]), f"columns {ours[0]} vs {theirs[0]}"
    if ours[1] != theirs[1]:
        left, right = set(ours[1]), set(theirs[1])
        return len(ours[1]), (f"{len(ours[1])} vs {len(theirs[1])} rows; ours only {list(left - right)[:3]}; "
                              f"SQL only {list(right - left)[:3]}")
    return len(ours[1]), None


if __name__ == "__main__":
    from wardline.session import build_session

    sf = sys.argv[1]
    names = sys.argv[2:] or list(entry.queries())
    session = build_session(master="local[8]", **{"spark.ui.enabled": "false", "spark.sql.shuffle.partitions": "8",
                                                  "spark.ui.showConsoleProgress": "false"})
    session.sparkContext.setLogLevel("ERROR")
    connection = connect(sf)
    for query in names:
        began = time.time()
        try:
            if query in entry.oracle_sql():
                rows, found = difference(session, connection, query, sf)
                verdict = found or f"ok, {rows} rows"
            else:
                verdict = f"rows only: {entry.queries()[query](session, sf).count()}"
        except Exception as error:  # noqa: BLE001
            verdict = f"{type(error).__name__}: {str(error)[:1500]}"
        print(f"{query:24s} {time.time() - began:6.2f}s  {verdict}", flush=True)

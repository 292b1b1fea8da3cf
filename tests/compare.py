"""Running a query next to its SQL and comparing the rows."""

from __future__ import annotations

import datetime
import decimal

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def oracle_connection(sf_dir: str):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def _plain(value):
    if isinstance(value, decimal.Decimal):
        return float(value)
    if isinstance(value, float):
        return round(value, 9) + 0.0
    if isinstance(value, (datetime.date, datetime.datetime)):
        return str(value)
    return value


def _sorted(rows):
    return sorted(rows, key=lambda row: tuple((v is None, str(type(v)), v if v is not None else 0) for v in row))


def spark_rows(df):
    names = sorted(df.columns)
    return names, _sorted([tuple(_plain(row[n]) for n in names) for row in df.collect()])


def oracle_rows(con, statement):
    table = con.execute(statement).to_arrow_table()
    names = sorted(table.column_names)
    columns = [table.column(n).to_pylist() for n in names]
    return names, _sorted([tuple(_plain(v) for v in row) for row in zip(*columns)])

"""Compares a query's rows with those of its DuckDB SQL on the same tables."""

import os

import duckdb


def duck_rows(sql: str, sf_dir: str) -> tuple[list[str], list[tuple]]:
    con = duckdb.connect()
    for name in os.listdir(sf_dir):
        con.execute(f"create view {name.split('.')[0]} as select * from '{sf_dir}/{name}'")
    found = con.sql(sql)
    return list(found.columns), found.fetchall()


def _value(v):
    return round(v, 9) if isinstance(v, float) else str(v)


def same_rows(df, sql: str, sf_dir: str) -> None:
    columns, want = duck_rows(sql, sf_dir)
    assert sorted(columns) == sorted(df.columns)
    order = sorted(columns)
    got = sorted((tuple(_value(r[c]) for c in order) for r in df.collect()), key=str)
    want = sorted((tuple(_value(r[columns.index(c)]) for c in order) for r in want), key=str)
    assert len(got) == len(want)
    for a, b in zip(got, want):
        for x, y in zip(a, b):
            assert x == y or float(x) == float(y), (a, b)

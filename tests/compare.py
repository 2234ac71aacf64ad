"""Run a registered query and its SQL on the same folder and compare all values."""

from __future__ import annotations

import glob
import math
import os

import duckdb


def connect(sf_dir: str):
    db = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        db.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    return db


def _cell(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value)
    return value


def spark_rows(df):
    names = sorted(df.columns)
    rows = [tuple(_cell(v) for v in row) for row in df.select(*names).collect()]
    return names, sorted(rows, key=repr)


def sql_rows(db, sql):
    result = db.execute(sql)
    names = [d[0] for d in result.description]
    order = sorted(range(len(names)), key=lambda i: names[i])
    rows = [tuple(_cell(row[i]) for i in order) for row in result.fetchall()]
    return [names[i] for i in order], sorted(rows, key=repr)

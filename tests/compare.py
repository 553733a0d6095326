"""Compares a Spark result with what DuckDB makes of its SQL, without regard to order."""

import math
from pathlib import Path


def _cell(x):
    if isinstance(x, float):
        return "nan" if math.isnan(x) else f"{x:.9g}"
    return str(x)


def _sorted(columns, rows):
    at = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_cell(r[i]) for i in at) for r in rows)


def same_rows(df, db, sf_dir, sql):
    for p in Path(sf_dir).glob("*.parquet"):
        db.execute(f"CREATE OR REPLACE VIEW {p.stem} AS SELECT * FROM '{p}'")
    got = db.execute(sql)
    names = [d[0] for d in got.description]
    want = got.fetchall()
    assert sorted(names) == sorted(df.columns)
    assert _sorted(df.columns, [tuple(r) for r in df.collect()]) == _sorted(names, want)

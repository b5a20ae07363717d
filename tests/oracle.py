"""Compare a registered query with its SQL, value by value."""

from __future__ import annotations

import glob
import os

import duckdb


def connect(sf_dir: str):
    db = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        db.sql(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return db


def _sorted(rows):
    return sorted(rows, key=lambda row: tuple((v is None, str(v)) for v in row))


_TYPES = {
    "string": "VARCHAR",
    "double": "DOUBLE",
    "bigint": "BIGINT",
    "boolean": "BOOLEAN",
    "timestamp_ntz": "TIMESTAMP",
}


def difference(spark_rows, db, sql: str) -> str | None:
    """None if names, types and all values agree, else what differs first."""
    names = sorted(spark_rows.columns)
    expected = db.sql(sql)
    if names != sorted(expected.columns):
        return f"columns {names} against {sorted(expected.columns)}"
    types = dict(zip(expected.columns, map(str, expected.types)))
    for field in spark_rows.schema.fields:
        if _TYPES[field.dataType.simpleString()] != types[field.name]:
            return f"type of {field.name}: {field.dataType.simpleString()} against {types[field.name]}"
    ours = _sorted(tuple(r) for r in spark_rows.select(*names).collect())
    quoted = ", ".join(f'"{n}"' for n in names)
    theirs = _sorted(db.sql(f"SELECT {quoted} FROM ({sql})").fetchall())
    if len(ours) != len(theirs):
        return f"{len(ours)} rows against {len(theirs)}"
    for mine, other in zip(ours, theirs):
        if mine != other:
            return f"{dict(zip(names, mine))} against {dict(zip(names, other))}"
    return None

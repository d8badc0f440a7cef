"""Compare every registered query with its SQL on the same Parquet files.

    python tests/parity.py /root/testdata/sf0.01 [name ...]
"""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir: str):
    db = duckdb.connect()
    for name in TABLES:
        db.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return db


def _value(v):
    if isinstance(v, float):
        return None if math.isnan(v) else v
    return v


def normal_rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(_value(row[i]) for i in order) for row in rows), key=repr)


def spark_rows(df):
    return sorted(df.columns), normal_rows(df.columns, df.collect())


def duck_rows(db, sql):
    result = db.execute(sql)
    columns = [c[0] for c in result.description]
    return sorted(columns), normal_rows(columns, result.fetchall())


def main() -> int:
    import __spark_entry__ as entry
    from storewright.session import local_session

    sf_dir, wanted = sys.argv[1], sys.argv[2:]
    spark, db, sql = local_session(8), connect(sf_dir), entry.oracle_sql()
    bad = 0
    for name, query in entry.queries().items():
        if wanted and name not in wanted or name not in sql:
            continue
        started = time.time()
        try:
            got_columns, got = spark_rows(query(spark, sf_dir))
            took = time.time() - started
            want_columns, want = duck_rows(db, sql[name])
            same = got_columns == want_columns and got == want
            note = "" if same else f" spark {got_columns} {got[:2]} duckdb {want_columns} {want[:2]}"
            note += f" {len(want)} expected" if len(want) != len(got) else ""
        except Exception as error:
            same, took, got, note = False, 0.0, [], str(error)[:600]
        bad += not same
        print(f"{'ok  ' if same else 'FAIL'} {name:28s} {len(got):8d} rows {took:6.2f}s{note[:900]}", flush=True)
    return bad


if __name__ == "__main__":
    sys.exit(main())

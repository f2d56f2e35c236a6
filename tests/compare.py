"""Run the registered queries in Spark and their SQL in DuckDB and compare the rows.

    python tests/compare.py [sf] [--sql] [name ...]

With --sql the queries without SQL are left out.
"""

from __future__ import annotations

import math
import sys
import time
from datetime import date, datetime
from pathlib import Path

import duckdb

ROOT = Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT))

# The names of the test tables.
TABLES = (
    "region nation customer supplier part orders lineitem events "
    "documents embeddings pages benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{sf_dir}/{t}.parquet'")
    return con


def cell(v):
    if v is None:
        return ("0",)
    if isinstance(v, bool):
        return ("b", v)
    if isinstance(v, float):
        return ("n", "nan") if math.isnan(v) else ("n", repr(v))
    if isinstance(v, int):
        return ("n", repr(float(v)))
    if isinstance(v, datetime):
        return ("t", v.isoformat())
    if isinstance(v, date):
        return ("t", v.isoformat())
    return ("s", str(v))


def normal(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(columns), sorted(tuple(cell(r[i]) for i in order) for r in rows)


def spark_rows(df):
    return normal(df.columns, [tuple(r) for r in df.collect()])


def duck_rows(con, sql):
    result = con.execute(sql)
    columns = [d[0] for d in result.description]
    return normal(columns, result.fetchall())


def difference(spark_side, duck_side) -> str | None:
    (sc, sr), (dc, dr) = spark_side, duck_side
    if sc != dc:
        return f"columns {set(sc) ^ set(dc)}"
    if len(sr) != len(dr):
        return f"rows {len(sr)} in Spark, {len(dr)} in SQL"
    wrong = [(a, b) for a, b in zip(sr, dr) if a != b]
    if wrong:
        a, b = wrong[0]
        where = [(c, x, y) for c, x, y in zip(sc, a, b) if x != y]
        return f"{len(wrong)} rows differ, first {where}"
    return None


def main(argv):
    from __spark_entry__ import oracle_sql, queries
    from reviewlab.session import session

    only_sql = "--sql" in argv
    argv = [a for a in argv if a != "--sql"]
    sf = argv[0] if argv else "0.01"
    sf_dir = f"/root/testdata/sf{sf}"
    spark = session(
        master="local[8]",
        **{
            "spark.sql.shuffle.partitions": "8",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": "16g",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    con, sqls, bad = connect(sf_dir), oracle_sql(), 0
    for name, run in queries().items():
        if argv[1:] and not any(name.startswith(p) for p in argv[1:]):
            continue
        if only_sql and name not in sqls:
            continue
        t = time.time()
        try:
            got = spark_rows(run(spark, sf_dir))
            note = "rows only"
            if name in sqls:
                wrong = difference(got, duck_rows(con, sqls[name]))
                note = wrong or "equal"
                bad += wrong is not None
        except Exception as e:  # report and go on with the other queries
            got, note, bad = ([], []), f"ERROR {type(e).__name__} {str(e)[:500]}", bad + 1
        print(f"{name:28s} {len(got[1]):8d} rows {time.time() - t:6.1f}s  {note}", flush=True)
    print("all equal" if not bad else f"{bad} FAILED")
    return bad


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv[1:]) else 0)

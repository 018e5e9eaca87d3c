"""Run registered queries against their SQL and compare whole results, types included."""

from __future__ import annotations

import datetime as dt
import math
import sys
import time

import duckdb

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]
SPARK_TYPE = {"BIGINT": "bigint", "INTEGER": "int", "DOUBLE": "double", "VARCHAR": "string",
              "DATE": "date", "TIMESTAMP": "timestamp", "BOOLEAN": "boolean"}


def _cell(value):
    if isinstance(value, float) and math.isnan(value):
        return "nan"
    if isinstance(value, dt.datetime):
        return value.replace(tzinfo=None)
    return value


def _rows(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted((tuple(_cell(r[i]) for i in order) for r in rows), key=repr)


def database(folder: str):
    con = duckdb.connect()
    for table in TABLES:
        con.sql(f"CREATE VIEW {table} AS SELECT * FROM '{folder}/{table}.parquet'")
    return con


def differences(con, sql: str, df) -> list[str]:
    """What differs between the SQL's result and the frame; empty when equal."""
    expected = con.sql(sql)
    names, got = expected.columns, df.collect()
    if sorted(names) != sorted(df.columns):
        return [f"columns {sorted(names)} / {sorted(df.columns)}"]
    found = []
    types = {n: SPARK_TYPE.get(str(t), str(t)) for n, t in zip(names, expected.types)}
    for name, spark_type in df.dtypes:
        if types[name] != spark_type:
            found.append(f"{name}: {types[name]} / {spark_type}")
    want = _rows(names, expected.fetchall())
    have = _rows(df.columns, [tuple(r) for r in got])
    if len(want) != len(have):
        found.append(f"{len(want)} / {len(have)} rows")
    unequal = [(w, h) for w, h in zip(want, have) if w != h]
    if unequal:
        found.append(f"{len(unequal)} unequal rows, first {unequal[0]}")
    return found


if __name__ == "__main__":
    sys.path.insert(0, ".")
    import __spark_entry__ as entry
    from tradeloom.session import build_session

    folder, wanted = sys.argv[1], sys.argv[2:]
    spark = build_session("compare", "local[8]", **{
        "spark.ui.enabled": "false", "spark.sql.shuffle.partitions": "8",
        "spark.driver.memory": "12g"})
    spark.sparkContext.setLogLevel("ERROR")
    con, sqls, bad = database(folder), entry.oracle_sql(), 0
    for name, query in entry.queries().items():
        if wanted and name not in wanted:
            continue
        start = time.time()
        try:
            df = query(spark, folder)
            found = differences(con, sqls[name], df) if name in sqls else [f"no SQL, {df.count()} rows"]
        except Exception as error:  # report and go on with the next query
            found = [f"{type(error).__name__}: {str(error)[:500]}"]
        bad += bool(found)
        print(f"{'ok ' if not found else 'BAD'} {name} {time.time() - start:.2f}s {'; '.join(found)[:700]}",
              flush=True)
    print("differences:", bad)

"""Compares registered queries with their SQL on DuckDB. Run as a script with names, or
through test_oracle.py."""

from __future__ import annotations

import math
import os
import sys
import time

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def _value(v):
    if v is None:
        return ""
    if isinstance(v, bool):
        return str(v)
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return repr(round(v, 9) + 0.0)
    return str(v)


def rows_of(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(tuple(_value(r[i]) for i in order) for r in rows)


def spark_types(df):
    kinds = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR",
             "boolean": "BOOLEAN"}
    return {f.name: kinds.get(f.dataType.simpleString(), f.dataType.simpleString())
            for f in df.schema.fields}


def compare(spark, con, name, query, sql, sf_dir):
    """None when equal, else what differs."""
    df = query(spark, sf_dir)
    got = [tuple(r) for r in df.collect()]
    answer = con.execute(sql)
    names = [d[0] for d in answer.description]
    types = {d[0]: str(d[1]) for d in answer.description}
    want = answer.fetchall()
    if sorted(names) != sorted(df.columns):
        return f"columns {sorted(df.columns)} vs {sorted(names)}"
    kinds = spark_types(df)
    wrong = {n: (kinds[n], types[n]) for n in names
             if kinds[n] != types[n] and types[n] not in ("NULL", '"NULL"')}
    a, b = rows_of(df.columns, got), rows_of(names, want)
    if a != b:
        only_a = [r for r in a if r not in set(b)][:3]
        only_b = [r for r in b if r not in set(a)][:3]
        return f"{len(a)} vs {len(b)} rows; columns {sorted(names)}\n  spark {only_a}\n  sql   {only_b}"
    if wrong:
        return f"types {wrong}"
    if not a:
        return "no rows"
    return None


def main(argv):
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    import __spark_entry__ as e
    from conftest import make_session

    sf_dir = os.environ.get("SF_DIR", "/root/testdata/sf0.01")
    spark = make_session()
    con = connect(sf_dir)
    queries, oracles = e.queries(), e.oracle_sql()
    chosen = [n for n in queries if not argv or any(n.startswith(a) for a in argv)]
    bad = 0
    for name in chosen:
        start = time.time()
        try:
            if name in oracles:
                problem = compare(spark, con, name, queries[name], oracles[name], sf_dir)
            else:
                n = queries[name](spark, sf_dir).count()
                problem = None if n else "no rows"
        except Exception as ex:
            problem = f"{type(ex).__name__}: {str(ex)[:700]}"
        bad += problem is not None
        print(f"{'ok  ' if problem is None else 'FAIL'} {name} {time.time() - start:.2f}s"
              + (f"\n  {problem}" if problem else ""), flush=True)
    print(f"{len(chosen) - bad} of {len(chosen)} ok")


if __name__ == "__main__":
    main(sys.argv[1:])

"""Run named queries against their SQL. Usage: python -m tests.compare [sf_dir] [names...]"""

from __future__ import annotations

import datetime as dt
import decimal
import math
import sys
import time

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()
# Kinds of column types that must agree on both sides.
KINDS = {
    "BIGINT": "int",
    "INTEGER": "int",
    "HUGEINT": "hugeint",
    "DOUBLE": "float",
    "VARCHAR": "text",
    "BOOLEAN": "bool",
    "bigint": "int",
    "int": "int",
    "double": "float",
    "string": "text",
    "boolean": "bool",
}


def database(sf_dir):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def normal(value):
    if isinstance(value, float):
        return None if math.isnan(value) else round(value, 9)
    if isinstance(value, decimal.Decimal):
        return float(value)
    if isinstance(value, dt.datetime):
        return value.replace(tzinfo=None).isoformat()
    return value


def difference(df, con, sql):
    """None when both sides agree, else what differs."""
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    if sorted(names) != sorted(df.columns):
        return f"columns {sorted(df.columns)} != {sorted(names)}"
    kinds = {d[0]: KINDS.get(str(d[1]), str(d[1])) for d in result.description}
    for name, kind in df.dtypes:
        if KINDS.get(kind, kind) != kinds[name]:
            return f"type of {name}: {kind} != {kinds[name]}"
    order = sorted(names)
    at = [names.index(n) for n in order]
    want = sorted((tuple(normal(r[i]) for i in at) for r in result.fetchall()), key=repr)
    got = sorted((tuple(normal(r[n]) for n in order) for r in df.collect()), key=repr)
    if want == got:
        return None if want else "no rows"
    extra = [r for r in got if r not in set(want)][:2]
    lacking = [r for r in want if r not in set(got)][:2]
    return f"{len(got)} rows, want {len(want)}; {order}\n   extra {extra}\n   lacking {lacking}"


def main(argv):
    sys.path.insert(0, ".")
    import __spark_entry__ as entry
    from pyspark.sql import SparkSession

    sf_dir = argv[0] if argv else "/root/testdata/sf0.01"
    # A session as any caller may make it: the library's settings are not in it.
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con, sql, bad = database(sf_dir), entry.oracle_sql(), 0
    for name, query in entry.queries().items():
        if argv[1:] and not any(name == a or (a.endswith("*") and entry.ENTRIES[name][0].__module__.endswith(a[:-1])) for a in argv[1:]):
            continue
        start = time.time()
        try:
            df = query(spark, sf_dir)
            if name in sql:
                problem = difference(df, con, sql[name])
                plan = df._jdf.queryExecution().executedPlan().toString()
                for node in ("NestedLoop", "Cartesian", "EvalPython"):
                    if node in plan:
                        print("   plan has", node)
            else:
                problem = None if df.count() else "no rows"
        except Exception as error:  # report and go on with the next query
            problem = f"{type(error).__name__}: {str(error)[:1500]}"
        bad += problem is not None
        print(f"{'ok  ' if problem is None else 'FAIL'} {name} {time.time() - start:.1f}s"
              f"{'' if name in sql else ' (rows only)'}", flush=True)
        if problem:
            print("  ", problem, flush=True)
    print("failures:", bad)


if __name__ == "__main__":
    main(sys.argv[1:])

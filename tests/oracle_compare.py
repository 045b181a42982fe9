"""Run registered queries next to their SQL and compare the results.

    python tests/oracle_compare.py [folder of tables] [query ...]
"""

import math
import pathlib
import sys
import time

sys.path.insert(0, str(pathlib.Path(__file__).resolve().parent.parent))

import duckdb  # noqa: E402

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def connect(sf_dir):
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def kind(type_name):
    """One name for the types that both engines call differently."""
    names = {
        "bigint": "long",
        "integer": "int",
        "varchar": "string",
        "boolean": "boolean",
        "double": "double",
        "float": "float",
    }
    return names.get(str(type_name).lower(), str(type_name).lower())


def cell(value):
    if isinstance(value, float) and math.isnan(value):
        return "NaN"
    return value


def in_order(rows, columns):
    names = sorted(columns)
    at = [columns.index(n) for n in names]
    picked = [tuple(cell(r[i]) for i in at) for r in rows]
    return names, sorted(picked, key=repr)


def compare(spark_df, relation):
    """None if equal, else what differs."""
    s_types = {f.name: kind(f.dataType.simpleString()) for f in spark_df.schema}
    d_types = {n: kind(t) for n, t in zip(relation.columns, relation.types)}
    if s_types != d_types:
        return f"schema {sorted(set(s_types.items()) ^ set(d_types.items()))}"
    s_names, s_rows = in_order([tuple(r) for r in spark_df.collect()], spark_df.columns)
    _, d_rows = in_order(relation.fetchall(), list(relation.columns))
    if len(s_rows) != len(d_rows):
        return f"rows {len(s_rows)} {len(d_rows)}"
    wrong = [(a, b) for a, b in zip(s_rows, d_rows) if a != b]
    return f"{len(wrong)} rows differ in {s_names}, first {wrong[0]}" if wrong else None


def main(argv):
    from pyspark.sql import SparkSession

    import __spark_entry__ as entry

    sf_dir = argv[0] if argv else "/root/testdata/sf0.01"
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    oracles = entry.oracle_sql()
    failed = []
    for name, query in entry.queries().items():
        if argv[1:] and name not in argv[1:]:
            continue
        start = time.time()
        try:
            df = query(spark, sf_dir)
            if name in oracles:
                verdict = compare(df, con.sql(oracles[name]))
            else:
                verdict = None if df.count() else "no rows"
        except Exception as e:
            verdict = f"{type(e).__name__}: {str(e)[:600]}"
        against = "sql" if name in oracles else "rows"
        print(f"{name:28}{against:6}{time.time() - start:6.1f}s {verdict or 'ok'}", flush=True)
        if verdict:
            failed.append(name)
    print("failed:", failed)
    return len(failed)


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))

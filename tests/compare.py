"""Run queries against their SQL: ``python tests/compare.py FOLDER [names]``."""

import os
import sys
import time

import duckdb
import pandas as pd

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def database(folder):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return con


def tidy(frame: pd.DataFrame) -> pd.DataFrame:
    frame = frame[sorted(frame.columns)].astype(object).where(frame.notna(), None)
    frame = frame.map(lambda v: None if v is None else str(v))
    return frame.sort_values(list(frame.columns), na_position="first").reset_index(drop=True)


def difference(spark_rows: pd.DataFrame, sql_rows: pd.DataFrame) -> str:
    """Empty when both hold the same rows."""
    if sorted(spark_rows.columns) != sorted(sql_rows.columns):
        return f"columns {sorted(spark_rows.columns)} != {sorted(sql_rows.columns)}"
    for name in spark_rows.columns:
        a, b = spark_rows[name].dtype, sql_rows[name].dtype
        if a != b and "object" not in (str(a), str(b)) and not (
            str(a).startswith(("int", "float")) and str(b).startswith(("int", "float"))
        ):
            return f"type of {name}: {a} != {b}"
    if len(spark_rows) != len(sql_rows):
        return f"rows {len(spark_rows)} != {len(sql_rows)}"
    a, b = tidy(spark_rows), tidy(sql_rows)
    wrong = (a.fillna("\0") != b.fillna("\0")).any(axis=1)
    if wrong.any():
        at = wrong.idxmax()
        return f"{wrong.sum()} rows differ, first\n  {a.loc[at].to_dict()}\n  {b.loc[at].to_dict()}"
    return ""


def integers(frame: pd.DataFrame) -> pd.DataFrame:
    """Nullable integers as such, so that a NULL does not print the others as floats."""
    for name in frame.columns:
        if str(frame[name].dtype).startswith("float"):
            frame[name] = frame[name].astype("Int64")
    return frame


def check(spark, con, name, query, sql, folder) -> str:
    return difference(integers(query(spark, folder).toPandas()), integers(con.sql(sql).df()))


if __name__ == "__main__":
    from pyspark.sql import SparkSession

    import __spark_entry__ as entry

    spark = (
        SparkSession.builder.master("local[8]").config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "8g").config("spark.ui.enabled", "false").getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    folder, names = sys.argv[1], sys.argv[2:]
    con, sql, bad = database(folder), entry.oracle_sql(), 0
    for name, query in entry.queries().items():
        if names and name not in names:
            continue
        start = time.time()
        try:
            problem = check(spark, con, name, query, sql[name], folder)
        except Exception as error:  # noqa: BLE001
            problem = f"{type(error).__name__}: {str(error)[:1500]}"
        bad += bool(problem)
        print(f"{name:28s} {time.time() - start:6.2f}s {problem or 'same'}", flush=True)
    print("different:", bad)

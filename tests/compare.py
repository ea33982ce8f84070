"""Run registered queries next to their oracle and compare rows and values.

    python tests/compare.py SF_DIR [query ...]
"""

import os
import sys
import time

import duckdb
import pandas as pd

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def oracle_frame(sql: str, sf_dir: str) -> pd.DataFrame:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con.execute(sql).fetchdf()


def normal(df: pd.DataFrame) -> list[tuple]:
    df = df[sorted(df.columns)]

    def cell(v):
        if v is None or v is pd.NaT or v is pd.NA or (isinstance(v, float) and v != v):
            return "\0"
        if isinstance(v, bool):
            return str(v)
        if isinstance(v, float):
            return repr(v)
        return str(pd.Timestamp(v)) if hasattr(v, "year") else str(v)

    out = [tuple(cell(v) for v in row) for row in df.astype(object).itertuples(index=False)]
    return sorted(out)


def kinds(df: pd.DataFrame) -> dict[str, str]:
    return {c: df[c].dtype.kind for c in sorted(df.columns)}


def difference(mine: pd.DataFrame, theirs: pd.DataFrame) -> str | None:
    if sorted(mine.columns) != sorted(theirs.columns):
        return f"columns {sorted(mine.columns)} != {sorted(theirs.columns)}"
    if len(mine) != len(theirs):
        return f"rows {len(mine)} != {len(theirs)}"
    # Pandas has no plain integers with nulls, so either side may show them its own way.
    holed = [c for c in mine.columns if mine[c].isna().any()]
    whole = [c for c in holed if all(pd.api.types.is_numeric_dtype(t[c]) and (t[c].dropna() % 1 == 0).all() for t in (mine, theirs))]
    mine, theirs = mine.astype({c: "Int64" for c in whole}), theirs.astype({c: "Int64" for c in whole})
    ours, other = kinds(mine), kinds(theirs)
    odd = {c: (ours[c], other[c]) for c in ours if ours[c] != other[c]}
    a, b = normal(mine), normal(theirs)
    if a != b:
        bad = [(x, y) for x, y in zip(a, b) if x != y]
        return f"{len(bad)} of {len(a)} rows differ {odd}; first {bad[0]} of columns {sorted(mine.columns)}"
    return f"kinds {odd}" if odd else None


def main() -> None:
    from __spark_entry__ import oracle_sql, queries
    from dockflow.session import local_session

    sf_dir, names = sys.argv[1], sys.argv[2:]
    spark = local_session(cores=os.environ.get("BENCH_CPUS", "8"))
    spark.sparkContext.setLogLevel("ERROR")
    oracles = oracle_sql()
    failed = []
    for name, fn in queries().items():
        if names and name not in names:
            continue
        start = time.time()
        try:
            mine = fn(spark, sf_dir).toPandas()
            took = time.time() - start
            start = time.time()
            problem = difference(mine, oracle_frame(oracles[name], sf_dir)) if name in oracles else "no oracle"
        except Exception as e:  # noqa: BLE001
            took, problem, mine = time.time() - start, f"{type(e).__name__}: {str(e)[:600]}", pd.DataFrame()
        if problem and problem != "no oracle":
            failed.append(name)
        print(f"\n@@ {name}: {problem or 'ok'} rows={len(mine)} spark={took:.1f}s duck={time.time() - start:.1f}s", flush=True)
    print(f"\n@@ failed {len(failed)}: {failed}")


if __name__ == "__main__":
    main()

"""Run registered queries next to their SQL: python tests/check_oracle.py SF_DIR [query ...]"""

from __future__ import annotations

import glob
import os
import sys
import time

import duckdb
import numpy as np
import pandas as pd

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def normalise(frame: pd.DataFrame) -> pd.DataFrame:
    out = pd.DataFrame(index=frame.index)
    for c in sorted(frame.columns):
        s = frame[c]
        if pd.api.types.is_bool_dtype(s):
            out[c] = s.astype(str)
        elif pd.api.types.is_numeric_dtype(s):
            out[c] = s.astype("float64") + 0.0
        elif s.map(lambda v: isinstance(v, float) or v is None).all():
            out[c] = s.astype("float64")
        else:
            out[c] = s.map(lambda v: None if v is None else str(v)[:10] if hasattr(v, "year") else str(v))
    order = [c for c in out if out[c].dtype == object] + [c for c in out if out[c].dtype != object]
    return out.sort_values(order, na_position="first").reset_index(drop=True)


def differences(ours: pd.DataFrame, theirs: pd.DataFrame, exact: bool = True) -> list[str]:
    if sorted(ours.columns) != sorted(theirs.columns):
        return [f"columns {sorted(ours.columns)} vs {sorted(theirs.columns)}"]
    if len(ours) != len(theirs):
        return [f"rows {len(ours)} vs {len(theirs)}"]
    a, b = normalise(ours), normalise(theirs)
    notes = []
    for c in a:
        x, y = a[c].to_numpy(), b[c].to_numpy()
        if a[c].dtype == object or b[c].dtype == object:
            bad = [i for i in range(len(x)) if not (x[i] == y[i] or (pd.isna(x[i]) and pd.isna(y[i])))]
        else:
            same = (x == y) | (np.isnan(x) & np.isnan(y))
            if not exact:
                same |= np.isclose(x, y, rtol=1e-9, atol=1e-9)
            bad = np.flatnonzero(~same)
        if len(bad):
            i = bad[0]
            notes.append(f"{c}: {len(bad)} of {len(x)} differ, first {x[i]!r} vs {y[i]!r}")
    return notes


def connect(sf_dir: str):
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM read_parquet('{path}')")
    return con


def main() -> int:
    from pyspark.sql import SparkSession

    import __spark_entry__ as entry

    sf_dir, names = sys.argv[1], sys.argv[2:]
    spark = (SparkSession.builder.master("local[8]").config("spark.sql.shuffle.partitions", "8")
             .config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false")
             .config("spark.driver.memory", "8g").config("spark.sql.session.timeZone", "UTC").getOrCreate())
    spark.sparkContext.setLogLevel("OFF")
    con, sql, failures = connect(sf_dir), entry.oracle_sql(), 0
    for name, fn in entry.queries().items():
        if names and name not in names:
            continue
        start = time.time()
        try:
            ours = fn(spark, sf_dir).toPandas()
        except Exception as error:  # report and go on
            print(f"!! {name}: {str(error)[:500]}")
            failures += 1
            continue
        took = time.time() - start
        if name not in sql:
            print(f"-- {name}: {len(ours)} rows, no SQL ({took:.2f}s)", flush=True)
            continue
        start = time.time()
        try:
            theirs = con.execute(sql[name]).fetchdf()
        except Exception as error:
            print(f"!! {name}: SQL: {str(error)[:500]}")
            failures += 1
            continue
        notes = differences(ours, theirs)
        failures += bool(notes)
        print(f"{'XX' if notes else 'ok'} {name}: {len(ours)} rows ({took:.2f}s, sql {time.time() - start:.2f}s) {'; '.join(notes)}", flush=True)
    print(f"{failures} failing")
    return failures


if __name__ == "__main__":
    sys.exit(bool(main()))

import duckdb
import numpy as np
import pandas as pd


def norm(df):
    cols = sorted(df.columns)

    def one(x):
        if x is None or x is pd.NA or (isinstance(x, float) and np.isnan(x)):
            return None
        if isinstance(x, (bool, np.bool_)):
            return bool(x)
        return round(float(x), 9) if isinstance(x, (int, float, np.number)) else x
    return sorted(repr([one(v) for v in r]) for r in df[cols].astype(object).itertuples(index=False)), cols


def same_as_sql(spark, sql, got, **tables):
    """The frame equals the SQL over the given pandas or parquet tables."""
    con = duckdb.connect()
    for name, t in tables.items():
        if isinstance(t, str):
            con.execute(f"create view {name} as select * from read_parquet('{t}')")
        else:
            con.register(name, t.toArrow())
    assert norm(got.toPandas()) == norm(con.execute(sql).df())

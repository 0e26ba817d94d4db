"""Order-insensitive result comparison (Spark result vs DuckDB oracle)."""

from __future__ import annotations

import datetime as _dt
import decimal
import math


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return round(v, 6)
    if isinstance(v, decimal.Decimal):
        return round(float(v), 6)
    if isinstance(v, (_dt.datetime, _dt.date)):
        return v.isoformat(sep=" ") if isinstance(v, _dt.datetime) else v.isoformat()
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    if hasattr(v, "tolist"):
        return _norm(v.tolist())
    if isinstance(v, bool):
        return v
    if isinstance(v, int):
        return v
    return v


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [tuple(_norm(r[i]) for i in order) for r in rows]


def compare(spark_cols, spark_rows, duck_cols, duck_rows) -> dict:
    res = {"spark_rows": len(spark_rows), "oracle_rows": len(duck_rows),
           "schema_match": sorted(spark_cols) == sorted(duck_cols)}
    res["rows_match"] = len(spark_rows) == len(duck_rows)
    if res["schema_match"]:
        a = sorted(rows_of(spark_cols, spark_rows), key=repr)
        b = sorted(rows_of(duck_cols, duck_rows), key=repr)
        res["values_match"] = a == b
        if not res["values_match"]:
            sa, sb = set(map(repr, a)), set(map(repr, b))
            res["only_spark"] = sorted(sa - sb)[:3]
            res["only_oracle"] = sorted(sb - sa)[:3]
    else:
        res["values_match"] = False
        res["spark_cols"], res["oracle_cols"] = list(spark_cols), list(duck_cols)
    return res

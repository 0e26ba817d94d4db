"""Run and corpus quality reports (O-A8, O-A9, O-P1, O-P2, O-P8, O-P9)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from presslake.functions.text import col_, py_strip


def outcome(status) -> Column:
    """O-P1 / Q8: ``ok`` (200), ``error`` (any other status), ``lost``
    (no response at all → NULL status)."""
    s = col_(status)
    return F.when(s.isNull(), F.lit("lost")).when(s == 200, F.lit("ok")).otherwise(F.lit("error"))


def harvest_summary(df: DataFrame, site_col: str, status_col: str) -> DataFrame:
    """O-A8: per site, how many URLs came back ok / error / lost."""
    o = outcome(status_col)
    return df.groupBy(site_col).agg(
        F.count_if(o == "ok").cast("bigint").alias("n_ok"),
        F.count_if(o == "error").cast("bigint").alias("n_error"),
        F.count_if(o == "lost").cast("bigint").alias("n_lost"))


def fail_on_status(df: DataFrame, status_col: str, limit: int = 399) -> DataFrame:
    """O-P2: strict mode — the job fails when any status is above ``limit``."""
    bad = F.coalesce(col_(status_col), F.lit(0)) > limit
    msg = F.concat(F.lit("HTTP status "), col_(status_col).cast("string"), F.lit(f" > {limit}"))
    # A filter, not a dropped column: Catalyst cannot prune the check away.
    return df.where(F.when(bad, F.raise_error(msg)).isNull())


def field_completeness(df: DataFrame, group_col: str, fields) -> DataFrame:
    """O-A9: per group and field, rows where the field is missing (NULL or
    blank) — an ``unpivot`` then one aggregate."""
    long = df.select(group_col, *[F.col(f).cast("string").alias(f) for f in fields]).unpivot(
        group_col, list(fields), "field", "value")
    missing = F.col("value").isNull() | (py_strip(F.col("value")) == "")
    return long.groupBy(group_col, "field").agg(
        F.count(F.lit(1)).cast("bigint").alias("n_total"),
        F.count_if(missing).cast("bigint").alias("n_missing"))


def nonempty(text) -> Column:
    """O-P8 / O-M2: text with anything left after stripping white space."""
    return F.length(py_strip(F.coalesce(col_(text), F.lit("")))) > 0


def classify_value(json_text) -> Column:
    """O-P9: validation of a dynamic value (a JSON text): not a string →
    ``TypeError``; empty string → ``ValueError``; else NULL (accepted)."""
    v = F.try_parse_json(col_(json_text))
    t = F.schema_of_variant(v)
    s = F.try_variant_get(v, "$", "string")
    return (F.when(v.isNull() | (t != "STRING"), F.lit("TypeError"))
            .when(s == "", F.lit("ValueError")))

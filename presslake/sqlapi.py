"""SQL surface (O-Y2, O-Y4): SQL functions and named, parameterised statements.

``register_sql_functions`` creates session SQL functions (JVM-side: a SQL
UDF is inlined into the plan like any built-in expression), so SQL users get
the same extraction as the DataFrame API::

    SELECT p.page_id, l.pos, l.href FROM pages p, LATERAL pl_links(p.html) l

``UrlTable`` gives the named statements of a URL-status table (get, get by
status, upsert one, bulk insert) over the bucketed table of
:mod:`presslake.sources.sinks`, each a ``spark.sql`` call with bound
parameters — no SQL text is parsed by this library.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from presslake.functions.html import CLEAN_RE, HREF_RE, UNQUOTE_RE
from presslake.functions.text import PY_STRIP_RE
from presslake.operators.pagination import COUNTER_CURRENT_WORD, COUNTER_TOTAL_WORD
from presslake.operators.urls import insert_or_raise, normalize_status
from presslake.sources import sinks


def _lit(s: str) -> str:
    """Spark SQL string literal (backslashes and quotes escaped)."""
    return "'" + s.replace("\\", "\\\\").replace("'", "\\'") + "'"


def register_sql_functions(spark: SparkSession) -> list[str]:
    defs = {
        "pl_clean_html": f"(html STRING) RETURNS STRING RETURN regexp_replace(html, {_lit(CLEAN_RE)}, '')",
        "pl_hrefs": (f"(html STRING) RETURNS ARRAY<STRING> RETURN transform(regexp_extract_all(html, {_lit(HREF_RE)}, 1), "
                     f"v -> regexp_replace(v, {_lit('(?s)' + UNQUOTE_RE)}, '$1$2'))"),
        "pl_strip": f"(x STRING) RETURNS STRING RETURN regexp_replace(x, {_lit(PY_STRIP_RE)}, '')",
        "pl_page_count": ("(label STRING) RETURNS INT RETURN "
                          "coalesce(try_cast(element_at(split(coalesce(label, ''), ' '), -1) AS INT), 0)"),
        "pl_has_next": (f"(t STRING) RETURNS BOOLEAN RETURN coalesce("
                        f"try_cast(get(split(t, ' '), {COUNTER_CURRENT_WORD}) AS INT) < "
                        f"try_cast(get(split(t, ' '), {COUNTER_TOTAL_WORD}) AS INT), false)"),
    }
    for name, body in defs.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}{body}")
    spark.sql(f"""CREATE OR REPLACE TEMPORARY FUNCTION pl_links(html STRING)
                  RETURNS TABLE(pos INT, href STRING)
                  RETURN SELECT pos, col AS href FROM
                    (SELECT posexplode(transform(regexp_extract_all(regexp_replace(html, {_lit(CLEAN_RE)}, ''),
                                                                    {_lit(HREF_RE)}, 1),
                                                 v -> regexp_replace(v, {_lit('(?s)' + UNQUOTE_RE)}, '$1$2'))))""")
    return [*defs, "pl_links"]


class UrlTable:
    """Named statements of the URL-status table (``url`` key, ``status``,
    ``seq`` ordering)."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def _current(self) -> DataFrame:
        cur = sinks.read_versioned(self.spark, self.path)
        if cur is None:
            cur = self.spark.createDataFrame([], "url STRING, status STRING, seq BIGINT")
        return cur

    def get_urls(self) -> DataFrame:
        return self.spark.sql("SELECT url, status FROM {t}", t=self._current())

    def get_urls_by_status(self, status: str) -> DataFrame:
        return self.spark.sql("SELECT url, status FROM {t} WHERE status = :status",
                              args={"status": status}, t=self._current())

    def _next_seq(self) -> int:
        return (self._current().agg(F.max("seq")).first()[0] or 0) + 1

    def upsert_url(self, url: str, status: str) -> list[str]:
        row = self.spark.sql("SELECT :url AS url, :status AS status, CAST(:seq AS BIGINT) AS seq",
                             args={"url": url, "status": status, "seq": self._next_seq()})
        return sinks.upsert_buckets(self.spark, self.path, row.withColumn("status", normalize_status("status")))

    def bulk_insert_urls(self, batch: DataFrame) -> list[str]:
        """Plain INSERT semantics: fails on a duplicate key (in the batch or
        already stored) before anything is written."""
        base = self._next_seq()
        b = batch.select("url", normalize_status("status").alias("status"),
                         (F.lit(base) + F.monotonically_increasing_id()).alias("seq"))
        insert_or_raise(self._current(), b)
        return sinks.upsert_buckets(self.spark, self.path, b)

"""Queries: corpus reports and value validation (§2.13, O-P8, O-P9, O-S8)."""

from __future__ import annotations

from pyspark.sql import functions as F

from presslake.operators import corpus as C
from presslake.operators import quality as Q
from presslake.plans import sqlfrag as S
from presslake.plans.registry import query
from presslake.sources.tables import table

# Words of 7+ letters are broken after their 4th letter to exercise repair.
BREAK_RE_JAVA = r"(\p{L}{4})(\p{Ll}{3,})"


def _lang_sql() -> str:
    toks = f"regexp_split_to_array(lower(coalesce(text, '')), {S.lit(C.TOKEN_SPLIT)})"
    cnt = {lg: f"CAST(len(list_filter(toks, lambda w: w IN ({', '.join(S.lit(w) for w in ws)}))) AS BIGINT)"
           for lg, ws in C.PROFILES.items()}
    langs = sorted(C.PROFILES)
    cols = ", ".join(f"{cnt[lg]} AS c_{lg}" for lg in langs)
    best = f"greatest({', '.join('c_' + lg for lg in langs)})"
    case = " ".join(f"WHEN c_{lg} = best THEN '{lg}'" for lg in langs)
    return f"""
WITH t AS (SELECT doc_id, {toks} AS toks FROM documents),
c AS (SELECT doc_id, {cols} FROM t),
b AS (SELECT *, {best} AS best FROM c)
SELECT doc_id, CASE WHEN best = 0 THEN 'und' {case} END AS lang_detected, best AS lang_hits FROM b
"""


@query("lang_detect", _lang_sql(), op="O-M1 O-F23")
def q_lang_detect(spark, sf):
    d = table(spark, sf, "documents").select("doc_id", "text")
    return C.detect_lang(d, "text").select("doc_id", "lang_detected", "lang_hits")


@query("lang_report", f"""
WITH r AS ({_lang_sql()})
SELECT r.lang_detected, d.lang, CAST(count(*) AS BIGINT) AS n_docs
FROM r JOIN documents d ON r.doc_id = d.doc_id GROUP BY 1, 2
""", op="O-M1 report")
def q_lang_report(spark, sf):
    d = table(spark, sf, "documents").select("doc_id", "text", "lang")
    return C.detect_lang(d, "text").groupBy("lang_detected", "lang").agg(
        F.count(F.lit(1)).cast("bigint").alias("n_docs"))


@query("dehyphenate", f"""
WITH b AS (SELECT doc_id, text, regexp_replace(text, '(\\p{{L}}{{4}})(\\p{{Ll}}{{3,}})', '\\1-' || chr(10) || '\\2', 'g') AS broken
           FROM documents)
SELECT doc_id, CAST((length(broken) - length(text)) // 2 AS BIGINT) AS n_breaks,
       regexp_replace(broken, {S.lit(C.DEHYPHEN_RE)}, '\\1\\2', 'g') = text AS restored
FROM b
""", op="O-M3")
def q_dehyphenate(spark, sf):
    d = table(spark, sf, "documents").select("doc_id", "text")
    b = d.withColumn("broken", F.regexp_replace("text", BREAK_RE_JAVA, "$1-\n$2"))
    return b.select("doc_id", ((F.length("broken") - F.length("text")) / 2).cast("bigint").alias("n_breaks"),
                    (C.dehyphenate("broken") == F.col("text")).alias("restored"))


# No document is blank, so every tenth is blanked here, in two ways.
_BLANKED = "CASE WHEN doc_id % 20 = 0 THEN ' ' || chr(10) WHEN doc_id % 20 = 10 THEN NULL ELSE text END"


@query("nonempty_docs", f"""
SELECT doc_id, n_chars FROM (SELECT doc_id, n_chars, {_BLANKED} AS text FROM documents)
WHERE text IS NOT NULL AND {S.strip('text')} <> ''
""", op="O-P8 O-M2")
def q_nonempty_docs(spark, sf):
    text = F.when(F.col("doc_id") % 20 == 0, F.lit(" \n")).when(F.col("doc_id") % 20 == 10, F.lit(None).cast("string")).otherwise(F.col("text"))
    d = table(spark, sf, "documents").withColumn("text", text)
    return d.where(Q.nonempty("text")).select("doc_id", "n_chars")


_VALUE_SQL = """CASE WHEN event_type = 'click' THEN CAST(json_extract(props, '$.k') AS VARCHAR)
                     WHEN value < 1 THEN '""' ELSE '"' || event_type || '"' END"""


@query("validate_values", f"""
WITH v AS (SELECT event_id, {_VALUE_SQL} AS value_json FROM events)
SELECT event_id, value_json,
       CASE WHEN json_type(json(value_json)) <> 'VARCHAR' THEN 'TypeError'
            WHEN value_json = '""' THEN 'ValueError' END AS error_class
FROM v
""", op="O-P9 O-F18")
def q_validate_values(spark, sf):
    ev = table(spark, sf, "events")
    vj = (F.when(F.col("event_type") == "click", F.get_json_object("props", "$.k"))
          .when(F.col("value") < 1, F.lit('""'))
          .otherwise(F.concat(F.lit('"'), "event_type", F.lit('"'))))
    v = ev.select("event_id", vj.alias("value_json"))
    return v.select("event_id", "value_json", Q.classify_value("value_json").alias("error_class"))


@query("json_field", """
SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events
""", op="O-S8")
def q_json_field(spark, sf):
    ev = table(spark, sf, "events")
    return ev.select("event_id", F.try_variant_get(F.try_parse_json("props"), "$.k", "bigint").alias("k"))

"""Readers at the system boundary (O-S1, O-S2, O-S9, O-S10, landing folders).

URL lists are newline-delimited text files; the line order of a file is kept
as ``pos`` (file offset order) so "first occurrence" stays meaningful.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from presslake.functions.text import SPLITLINES_RE, py_strip

# Unified article schema (§1.3): every site is projected to it.
ARTICLE_SCHEMA = T.StructType([
    T.StructField("site", T.StringType()),
    T.StructField("url", T.StringType()),
    T.StructField("status", T.IntegerType()),
    T.StructField("title", T.StringType()),
    T.StructField("content", T.ArrayType(T.StringType())),
    T.StructField("category", T.StringType()),
    T.StructField("author", T.StringType()),
    T.StructField("published_raw", T.StringType()),
    T.StructField("published", T.DateType()),
    T.StructField("tags", T.StringType()),
    T.StructField("image_url", T.StringType()),
    T.StructField("image_file", T.StringType()),
    T.StructField("description", T.StringType()),
    T.StructField("price", T.DecimalType(10, 2)),
    T.StructField("edition_id", T.StringType()),
])


def read_url_list(spark: SparkSession, path: str, keep_blank: bool = False) -> DataFrame:
    """O-S1 / O-S2: ``(site, file, pos, url)`` one row per URL line.

    Read line by line (files split across tasks).  ``pos`` is a sortable
    struct (split start offset, row id, sub-line) that follows file order:
    within a split rows keep their order, splits are ordered by offset.
    Python's extra line breaks (Q14: ``\\v \\f \\x1c-\\x1e \\x85 \\u2028 \\u2029``)
    split a Spark line further.  Blank lines (Q4) are dropped unless
    ``keep_blank``.
    """
    raw = spark.read.text(path).select(
        F.col("_metadata.file_name").alias("file"),
        F.col("_metadata.file_block_start").alias("_block"),
        F.monotonically_increasing_id().alias("_row"),
        "value")
    lines = raw.select("file", "_block", "_row",
                       F.posexplode(F.split("value", SPLITLINES_RE)).alias("_sub", "url"))
    lines = lines.withColumn("url", py_strip("url"))
    if not keep_blank:
        lines = lines.where(F.col("url") != "")
    site = F.regexp_extract("file", r"^(?:articles|categories|retry)?-?([^.]+?)(?:-small)?\.txt$", 1)
    pos = F.struct(F.col("_block").alias("block"), F.col("_row").alias("row"), F.col("_sub").alias("sub"))
    return lines.select(site.alias("site"), "file", pos.alias("pos"), "url")


def read_categories(spark: SparkSession, path: str, slug_part: int | None = 4) -> DataFrame:
    """O-S2: category seed pages — a URL list plus ``category_slug``: path
    part ``slug_part`` (``url.split("/")[4]``), or, when ``slug_part`` is
    None, the last path part without ``.html``; query-string seeds keep
    their ``catid`` value."""
    df = read_url_list(spark, path)
    if slug_part is not None:
        slug = F.get(F.split(F.regexp_replace("url", r"[?#].*$", ""), "/"), slug_part)
    else:
        slug = F.regexp_extract("url", r"([^/?#]+?)(?:\.html)?(?:[?#].*)?$", 1)
    catid = F.regexp_extract("url", r"[?&]catid=([^&#]*)", 1)
    return df.withColumn("category_slug", F.when(catid != "", catid).otherwise(slug))


def read_articles_jsonl(spark: SparkSession, path: str) -> DataFrame:
    """O-S9: JSON lines back with the fixed article schema (never inferred:
    rows drift between sites and between ok and error records)."""
    return spark.read.schema(ARTICLE_SCHEMA).json(path)


def read_landing(spark: SparkSession, path: str) -> DataFrame:
    """Landing folder of fetched assets (``binaryFile``): path, length, bytes.
    Used for presence checks of manifests; bytes are pruned when unused."""
    return spark.read.format("binaryFile").load(path)


def synthetic_urls(df: DataFrame, id_col: str, seed: int = 42,
                   statuses=("new", "error", "done")) -> DataFrame:
    """O-S10: one unique URL per input row with a status picked by the first
    digit of ``md5("<id>:<seed>")``, not ``rand()``, so the result does not
    depend on partitioning or retries."""
    digit = F.substr(F.md5(F.concat(F.col(id_col).cast("string"), F.lit(f":{seed}"))), F.lit(1), F.lit(1))
    h = F.position(digit, F.lit("0123456789abcdef")) - 1
    arr = F.array(*[F.lit(s) for s in statuses])
    return df.select(
        F.concat(F.lit("https://u"), F.col(id_col).cast("string"), F.lit(".example.net/")).alias("url"),
        F.element_at(arr, (F.pmod(h, F.lit(len(statuses))) + 1).cast("int")).alias("status"))

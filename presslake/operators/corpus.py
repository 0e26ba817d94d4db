"""Corpus operators named in the notes (O-M1 language, O-M3 de-hyphenation).

Language detection is one projection: the text is tokenised once, and each
language's marker words are counted with ``filter`` over the token array —
no explode, no join, no shuffle; the profiles are literals in the plan.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from presslake.functions.text import col_

# ---- fixed values -------------------------------------------------------
# Marker words per language (frequent function words unique to one of the four
# languages of the corpus).  Order of LANGS is the tie-break order.
PROFILES = {
    "de": ["der", "die", "und", "den", "von", "zu", "das", "mit", "sich", "nicht"],
    "en": ["the", "of", "and", "to", "is", "that", "was", "with"],
    "es": ["el", "y", "los", "del", "las", "por", "con", "una", "para"],
    "fr": ["le", "et", "les", "des", "du", "une", "pour", "est", "dans"],
}
TOKEN_SPLIT = r"[^\p{L}]+"
DEHYPHEN_RE = r"(\p{L})-\n(\p{Ll})"
# -------------------------------------------------------------------------


def tokens(text) -> Column:
    return F.split(F.lower(F.coalesce(col_(text), F.lit(""))), TOKEN_SPLIT)


def marker_counts(text) -> dict[str, Column]:
    """Marker-word hits per language.  The text is normalised once to
    ``' tok tok … '`` (lower case, runs of non-letters → one space); a
    language's hits are one ``regexp_count`` of its words between spaces
    (look-ahead, so adjacent hits both count).  No per-token lambda: the
    projection stays in whole-stage codegen."""
    t = F.concat(F.lit(" "), F.regexp_replace(F.lower(F.coalesce(col_(text), F.lit(""))), TOKEN_SPLIT, " "),
                 F.lit(" "))
    return {lang: F.regexp_count(t, F.lit(" (?:" + "|".join(ws) + ")(?= )")).cast("bigint")
            for lang, ws in PROFILES.items()}


def detect_lang(df: DataFrame, text_col: str = "text") -> DataFrame:
    """O-M1: adds ``lang_detected`` (argmax of marker counts; ties → first
    language in alphabetical order; no marker → ``'und'``) and ``lang_hits``."""
    counts = marker_counts(text_col)
    # greatest over (count, -rank) structs: highest count, then earliest lang
    langs = sorted(PROFILES)
    best = F.greatest(*[F.struct(counts[lg].alias("n"), F.lit(-i).alias("r"), F.lit(lg).alias("lang"))
                        for i, lg in enumerate(langs)])
    return (df.withColumn("_best", best)
            .withColumn("lang_detected", F.when(F.col("_best.n") > 0, F.col("_best.lang")).otherwise(F.lit("und")))
            .withColumn("lang_hits", F.col("_best.n")).drop("_best"))


def dehyphenate(text) -> Column:
    """O-M3: join words broken at a line end (``exam-\\nple`` → ``example``)."""
    return F.regexp_replace(col_(text), DEHYPHEN_RE, "$1$2")

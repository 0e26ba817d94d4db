"""Operator 8, quality rules: robust multivariate outliers.

Each text is described by counts; the counts, transformed, form a vector.  For
every language and source the minimum-covariance-determinant estimate gives
the centre and scatter of the vectors' closest half, and texts whose
Mahalanobis distance to it is beyond a cutoff are rejected.  Two plain rules
(too few words, too many repeated words) come first.

* Concentration steps start from three estimates (medians and their deviations
  alone, with the correlations of tanh scores, with those of spatial signs);
  after TRIALS steps each group goes on with that of the smallest determinant,
  until its determinant falls no more; groups that have settled leave the steps.
* A statistic of a text of n words has a sampling error of about GRAIN / n.
  Estimates include that of SURE words (the regularised form of the
  method, so that constant statistics have a scatter); a shorter text's
  differences are scaled down by its larger error.  A longer text is not judged
  more sharply, and length by itself is no fault.
* The cutoff is the chi-square quantile for as many dimensions, at a chance of
  one in a million; it is not fitted to a table (the README says what was looked at).

Counts are made in one pass over the texts, without a shuffle.  Vectors are
whole numbers (fixed point), so the sums from which Spark makes centres and
scatters are exact, whatever order tasks end in.  Each concentration step is
two map-side combined aggregations over the small table of vectors: a
histogram of squared distances, which gives the half's radius, and the sums
within that radius.  One row per group is all that a step gathers.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from presslake.llm.common import BROADCAST_ROWS, importable, stage, utf8, worker_store

MIN_WORDS = 20          #: fewer words fail
MAX_REPEAT = 30         #: more per cent of the words in repeated windows fail
WINDOW = 8              #: words of a window
SYMBOLS = b"#*$%&|<>"
SCALE = 1024            #: fixed point of the vectors
MIN_GROUP = 200         #: smaller groups share that of their language's small ones, else of all its texts, else of the whole table
TRIALS = 2              #: concentration steps of every start
STEPS = 30              #: further steps of the best one, at most
SETTLED = 1e-3          #: a group has settled if its log determinant falls by no more
BINS = 64               #: of the histogram of distances, to each factor of two
CUTOFF = 5.990675       #: root of the chi-square quantile at 1 - 1e-6, five dimensions
SALTS = 16
SEGMENT = 1 << 19       #: bytes that are hashed at once

STATS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_stutters")
VECTOR = ("v_word", "v_symbols", "v_lines", "v_repeat", "v_stutter")
#: Sampling variance of each statistic, times the words of the text: word
#: lengths have a variance of about 6; the root of a share has 1/4 per event,
#: and repeated windows come two at a time, 2 * WINDOW words an event.
GRAIN = (6.0, 0.25, 0.25, 0.25 * 2 * WINDOW, 0.25)
#: Words from which on a text's sampling error is taken as no smaller: 256, and
#: for repeated windows 64 events.
SURE = (256, 256, 256, 64 * 2 * WINDOW, 256)
#: Scatter of a normal sample over that of its inner half, five dimensions:
#: 0.5 / P(chi2_7 <= q), where P(chi2_5 <= q) = 0.5.
HALF_FACTOR = 0.5 / 0.261478

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(SYMBOLS)] = True
_BASE = 0x9E3779B97F4A7C15
_POWERS: list[np.ndarray] = []


def _powers() -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd number and of its inverse, modulo 2**64."""
    if not _POWERS:
        for b in (_BASE, pow(_BASE, -1, 1 << 64)):
            p = np.full(SEGMENT + 1, b, np.uint64)
            p[0] = 1
            _POWERS.append(np.multiply.accumulate(p))
    return _POWERS[0], _POWERS[1]


def span_hashes(data: np.ndarray, s: np.ndarray, e: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each byte span [s, e); spans in order, not overlapping."""
    import xxhash
    power, inverse = _powers()
    out = np.zeros(len(s), np.uint64)
    i = 0
    while i < len(s):
        j = int(np.searchsorted(e, s[i] + SEGMENT, "right"))
        if j <= i:
            out[i] = xxhash.xxh64_intdigest(data[s[i]:e[i]].tobytes())
            i += 1
            continue
        lo, hi = int(s[i]), int(e[j - 1])
        sums = np.zeros(hi - lo + 1, np.uint64)
        np.cumsum((data[lo:hi].astype(np.uint64) + np.uint64(1)) * power[:hi - lo], out=sums[1:])
        out[i:j] = (sums[e[i:j] - lo] - sums[s[i:j] - lo]) * inverse[s[i:j] - lo]
        i = j
    out ^= out >> np.uint64(29)
    out *= np.uint64(0xBF58476D1CE4E5B9)
    out ^= out >> np.uint64(32)
    return out


def _having_twice(keys: np.ndarray, of: np.ndarray) -> np.ndarray:
    """The texts (``of``) that have two equal keys; keys of two texts differ."""
    keys = keys + of.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)
    k = np.sort(keys)
    twice = np.unique(k[1:][k[1:] == k[:-1]])
    if not len(twice):
        return of[:0]
    at = np.minimum(np.searchsorted(twice, keys), len(twice) - 1)
    return np.unique(of[twice[at] == keys])


def repeated_words(words: list[bytes], window: int = WINDOW) -> int:
    """How many words lie in windows that occur twice or more."""
    number: dict[bytes, int] = {}
    ids = [number.setdefault(w, len(number)) for w in words]
    first: dict[tuple, int] = {}
    covered = bytearray(len(ids))
    for i in range(len(ids) - window + 1):
        j = first.setdefault(tuple(ids[i:i + window]), i)
        if j != i:
            covered[i:i + window] = b"\1" * window
            covered[j:j + window] = b"\1" * window
    return sum(covered)


def duplicate_lines(text: bytes) -> int:
    """Lines with a word that equal an earlier line."""
    lines = [x for x in text.split(b"\n") if x.strip()]
    return len(lines) - len(set(lines))


def text_statistics(data: np.ndarray, off: np.ndarray) -> np.ndarray:
    """The counts STATS of texts (rows), given their UTF-8 bytes and offsets.

    Hashes find the texts that have repeated windows or lines at all; those
    are counted exactly."""
    n = len(off) - 1
    out = np.zeros((n, len(STATS)), np.int64)
    if not len(data):
        return out
    space = _SPACE[data]
    start = np.zeros(len(data) + 1, bool)
    start[off] = True                       # a text begins (or all end) here
    begin = ~space
    begin[1:] &= space[:-1] | start[1:-1]
    end = ~space
    end[:-1] &= space[1:] | start[1:-1]
    ws, we = np.flatnonzero(begin), np.flatnonzero(end) + 1
    wdoc = np.searchsorted(off, ws, "right") - 1
    per = lambda mask: np.diff(np.concatenate(([0], np.cumsum(mask)))[off])
    out[:, 0] = np.bincount(wdoc, minlength=n)
    out[:, 1] = per(((data & 0xC0) != 0x80) & ~space)
    out[:, 2] = per(_SYMBOL[data])
    h = span_hashes(data, ws, we)
    same = (h[1:] == h[:-1]) & (wdoc[1:] == wdoc[:-1])  # a word that equals the one before it
    out[:, 5] = np.bincount(wdoc[1:][same], minlength=n)
    if len(ws) >= WINDOW:
        win = np.zeros(len(h) - WINDOW + 1, np.uint64)
        for k in range(WINDOW):
            win = win * np.uint64(0x2545F4914F6CDD1D) + h[k:len(h) - WINDOW + 1 + k]
        inside = wdoc[WINDOW - 1:] == wdoc[:len(win)]
        for i in _having_twice(win[inside], wdoc[:len(win)][inside]).tolist():
            out[i, 4] = repeated_words(data[off[i]:off[i + 1]].tobytes().split())
    cut = np.flatnonzero((data == 0x0A))
    ls = np.union1d(cut + 1, off[:-1])
    ls = ls[ls < len(data)]
    le = np.append(ls[1:], len(data))
    le = le - (data[le - 1] == 0x0A)       # without the line's end
    words = np.concatenate(([0], np.cumsum(~space)))
    full = words[le] > words[ls]
    ls, le = ls[full], le[full]
    if len(ls):
        for i in _having_twice(span_hashes(data, ls, le), np.searchsorted(off, ls, "right") - 1).tolist():
            out[i, 3] = duplicate_lines(data[off[i]:off[i + 1]].tobytes())
    return out


def add_statistics(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with the columns STATS of each whole text (null: empty).  All
    other columns stay; a column of such a name is replaced."""
    from pyspark.sql.types import LongType, StructType

    from presslake.llm.common import blocks
    kept = [c for c in docs.columns if c not in STATS]

    def run(batches):
        import pyarrow as pa
        worker_store("quality")
        for b in batches:
            data, off = utf8(b.column(b.schema.get_field_index(text)))
            rows = [text_statistics(data[off[i]:off[j]], off[i:j + 1] - off[i]) for i, j in blocks(off, SEGMENT)]
            rows = np.concatenate(rows) if rows else np.zeros((0, len(STATS)), np.int64)
            yield pa.RecordBatch.from_arrays([*(b.column(b.schema.get_field_index(c)) for c in kept), *(pa.array(rows[:, k]) for k in range(len(STATS)))], names=[*kept, *STATS])

    importable(docs.sparkSession)
    schema = StructType([docs.schema[c] for c in kept])
    for c in STATS:
        schema = schema.add(c, LongType())
    return docs.mapInArrow(run, schema)


def base_failed():
    return (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT * F.col("n_words"))


def _vector() -> list:
    """The transformed statistics, fixed point."""
    words = F.greatest(F.col("n_words"), F.lit(1))
    raw = (F.col("word_chars") / words, *(F.sqrt(F.col(c) / words) for c in STATS[2:]))
    return [F.round(x * SCALE).cast("long").alias(name) for x, name in zip(raw, VECTOR, strict=True)]


def _distance2(words=None):
    """Squared Mahalanobis distance of a row's vector, from the columns m0..
    (centre), s0.. (variances) and i00.. (inverse scatter) of its group.  Given
    the text's ``words``, differences are scaled for its sampling error."""
    p = len(VECTOR)
    d = [F.col(v) / SCALE - F.col(f"m{k}") for k, v in enumerate(VECTOR)]
    if words is not None:
        error = [GRAIN[k] / F.least(F.greatest(words, F.lit(1)), F.lit(SURE[k])) for k in range(p)]
        d = [x * F.sqrt((F.col(f"s{k}") + GRAIN[k] / SURE[k]) / (F.col(f"s{k}") + error[k])) for k, x in enumerate(d)]
    total = None
    for a in range(p):
        for b in range(a, p):
            term = (1.0 if a == b else 2.0) * F.col(f"i{a}{b}") * d[a] * d[b]
            total = term if total is None else total + term
    return total


PAIRS = [(a, b) for a in range(len(VECTOR)) for b in range(a, len(VECTOR))]
FIT = "g string, " + ", ".join(f"{c} double" for c in [*(f"m{k}" for k in range(len(VECTOR))), *(f"s{k}" for k in range(len(VECTOR))), *(f"i{a}{b}" for a, b in PAIRS), "det"])


def _products(columns, name: str) -> list:
    """Sums of the products of all pairs of whole-number columns."""
    return [F.sum(F.col(columns[a]) * F.col(columns[b])).alias(f"{name}{a}{b}") for a, b in PAIRS]


def _moments() -> list:
    return [F.count("*").alias("n"), *(F.sum(v).alias(f"t{k}") for k, v in enumerate(VECTOR)), *_products(VECTOR, "q")]


def _square(t, name: str) -> np.ndarray:
    """The columns ``name``00.. of a pandas frame as symmetric matrices."""
    out = np.zeros((len(t), len(VECTOR), len(VECTOR)))
    for a, b in PAIRS:
        out[:, a, b] = out[:, b, a] = t[f"{name}{a}{b}"].to_numpy(float)
    return out


def _estimate(g, mean: np.ndarray, cov: np.ndarray):
    """A pandas frame of FIT: centre, variances and inverse scatter (with the
    sampling error of SURE words) and its log determinant."""
    import pandas as pd
    scatter = cov + np.diag(np.divide(GRAIN, SURE))
    inv = np.linalg.inv(scatter)
    p = range(len(VECTOR))
    return pd.DataFrame({"g": g, **{f"m{k}": mean[:, k] for k in p}, **{f"s{k}": np.maximum(cov[:, k, k], 0) for k in p},
                         **{f"i{a}{b}": inv[:, a, b] for a, b in PAIRS}, "det": np.linalg.slogdet(scatter)[1]})


def _fit(sums: DataFrame, factor: float = 1.0) -> DataFrame:
    """The estimate of each group's sums, its scatter times ``factor``: one
    small row per group, inverted in tasks."""
    def run(batches):
        for t in batches:
            n = t["n"].to_numpy(float)
            mean = np.stack([t[f"t{k}"].to_numpy(float) / n / SCALE for k in range(len(VECTOR))], axis=1)
            cov = _square(t, "q") / n[:, None, None] / SCALE**2 - mean[:, :, None] * mean[:, None, :]
            yield _estimate(t["g"], mean, cov * factor)

    importable(sums.sparkSession)
    return sums.mapInPandas(run, FIT)


def _with_groups(vectors: DataFrame, fits: DataFrame, groups: int, how: str = "inner") -> DataFrame:
    """Join vectors with their group's estimate: broadcast if the groups are
    few, else by (group, salt), so that a hot group spreads over the salts."""
    if groups <= BROADCAST_ROWS:
        return vectors.join(F.broadcast(fits), "g", how)
    salted = fits.withColumn("_t", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    mixed = vectors.withColumn("_t", F.pmod(F.xxhash64(*VECTOR, *STATS), F.lit(SALTS)).cast("int"))
    return mixed.join(salted, ["g", "_t"], how).drop("_t")


def group_label(lang: str, source: str):
    """A text that names the language (null: its own) and source together."""
    part = lambda c: F.coalesce(F.concat(F.lit("="), F.col(f"`{c}`").cast("string")), F.lit("-"))
    return F.concat(part(lang), F.lit("\u0001"), part(source)), F.concat(part(lang), F.lit("\u0001*"))


def fit_groups(stats: DataFrame, lang: str = "lang", source: str = "source"):
    """Minimum-covariance-determinant estimates of the texts that pass the
    plain rules.  ``stats`` has STATS and the two columns.

    Returns (names, fits, number of groups): ``names`` maps each language and
    source (``label``) to its estimate's group ``g``; ``fits`` has one row per
    group.  Groups of fewer than MIN_GROUP texts are pooled by language; if a
    language's pool has fewer, its groups take the estimate of all texts of the
    language, and if these are fewer, that of all texts.  Only a table of fewer
    than MIN_GROUP texts has no estimate.
    """
    own, by_lang = group_label(lang, source)
    rows = stage(stats.where(~base_failed()).select(own.alias("label"), by_lang.alias("pool"), *STATS, *_vector()), "vectors")
    sizes = rows.groupBy("label", "pool").agg(F.count("*").alias("n"))
    of_lang = Window.partitionBy("pool")
    sizes = sizes.withColumn("pooled", F.sum(F.when(F.col("n") < MIN_GROUP, F.col("n"))).over(of_lang)).withColumn("whole", F.sum("n").over(of_lang))
    g = (F.when(F.col("n") >= MIN_GROUP, F.col("label")).when(F.col("pooled") >= MIN_GROUP, F.col("pool"))
         .when(F.col("whole") >= MIN_GROUP, F.concat("pool", F.lit("*"))).otherwise(F.lit("*")))
    sizes = stage(sizes.select("label", "pool", "n", g.alias("g")), "group-names")
    total = sizes.agg(F.sum("n")).first()[0]  # one number
    sizes = sizes.where(F.lit((total or 0) >= MIN_GROUP))
    names = sizes.select("label", "g")
    n_names = names.count()
    # Estimates of all texts of a language, and of the table, are made if a group takes them.
    whole = sizes.where(F.col("g") == F.concat("pool", F.lit("*"))).select("pool", "g").distinct()
    table = sizes.where("g = '*'").select("g").distinct()  # one row or none
    members = stage(names.unionByName(sizes.select("label", "pool").join(whole, "pool").select("label", "g"))
                    .unionByName(sizes.select("label").join(F.broadcast(table), F.lit(True)).select("label", "g")).distinct(), "members")
    if members.count() <= BROADCAST_ROWS:
        vectors = rows.join(F.broadcast(members), "label")
    else:
        salted = members.withColumn("_t", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        vectors = rows.withColumn("_t", F.pmod(F.xxhash64(*VECTOR, *STATS), F.lit(SALTS)).cast("int")).join(salted, ["label", "_t"]).drop("_t")
    vectors = stage(vectors.select("g", *STATS, *VECTOR), "group-vectors")
    return names, _concentrate(vectors), n_names


def _step(vectors: DataFrame, fits: DataFrame, groups: int) -> DataFrame:
    """One concentration step: the sums of each group's half that is closest to
    its estimate (equal distances, to a bin, together)."""
    d2 = _with_groups(vectors, fits, groups).select("g", *VECTOR, F.floor(F.log2(_distance2() + 1e-9) * BINS).cast("int").alias("bin"))
    hist = d2.groupBy("g", "bin").agg(F.count("*").alias("c"))
    upto = Window.partitionBy("g").orderBy("bin").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    half = (hist.withColumn("cum", F.sum("c").over(upto)).withColumn("all", F.sum("c").over(Window.partitionBy("g")))
            .where(2 * F.col("cum") >= F.col("all")).groupBy("g").agg(F.min("bin").alias("top")))
    inside = d2.join(F.broadcast(half) if groups <= BROADCAST_ROWS else half, "g").where("bin <= top")
    return stage(inside.groupBy("g").agg(*_moments()), "sums")


def _concentrate(vectors: DataFrame) -> DataFrame:
    """The estimate of each group (``g``) of the staged vectors."""
    fits = stage(_starts(vectors), "fit")
    of_start = vectors.withColumn("g", F.explode(F.array(*[F.concat("g", F.lit(x)) for x in STARTS])))
    groups = fits.count()
    for _ in range(TRIALS):
        sums = _step(of_start, fits, groups)
        fits = stage(_fit(sums), "fit")
    # Each group's start of the smallest determinant (of equal ones the first).
    best = (sums.join(fits.select("g", "det"), "g").withColumn("start", F.expr("right(g, 1)")).withColumn("g", F.expr("left(g, length(g) - 1)"))
            .groupBy("g").agg(F.min(F.struct("det", "start", *[c for c in sums.columns if c != "g"])).alias("b")).select("g", "b.*").drop("start"))
    left = stage(best, "sums").drop("det")  # the sums of groups that go on
    fits = stage(_fit(left), "fit")
    groups, settled = fits.count(), []
    for _ in range(STEPS):
        if not groups:
            break
        sums = _step(vectors, fits, groups)
        after = stage(_fit(sums).join(fits.select("g", F.col("det").alias("before")), "g").withColumn("moved", F.col("before") - F.col("det") > SETTLED), "fit")
        settled.append(sums.join(after.where("not moved").select("g"), "g", "left_semi"))
        left = sums.join(after.where("moved").select("g"), "g", "left_semi")
        fits = after.where("moved").drop("before", "moved")
        groups = fits.count()
    for t in settled:
        left = left.unionByName(t)
    # The closest half of a normal sample has a smaller scatter: consistency factor.
    return stage(_fit(left, HALF_FACTOR), "fit")


#: A letter for each start, added to the group's name during the trials.
STARTS = "abc"


def _starts(vectors: DataFrame) -> DataFrame:
    """First estimates of each group (FIT; its name and a letter of STARTS):
    medians and median absolute deviations without correlations, with those of
    tanh scores, and with those of spatial signs."""
    p = range(len(VECTOR))
    long = vectors.select("g", F.posexplode(F.array(*VECTOR)).alias("k", "v"))
    upto = Window.partitionBy("g", "k").orderBy("v").rowsBetween(Window.unboundedPreceding, Window.currentRow)

    def middle(t: DataFrame, out: str) -> DataFrame:
        """Each group's and coordinate's median of ``v`` at a grain of SCALE / 64."""
        hist = t.groupBy("g", "k", F.floor(F.col("v") / (SCALE // 64)).alias("v")).agg(F.count("*").alias("c"))
        hist = (hist.withColumn("cum", F.sum("c").over(upto)).withColumn("all", F.sum("c").over(Window.partitionBy("g", "k")))
                .where(2 * F.col("cum") >= F.col("all")).groupBy("g", "k").agg((F.min("v") / 64.0).alias(out)))
        return hist.groupBy("g").agg(*[F.max(F.when(F.col("k") == k, F.col(out))).alias(f"{out}{k}") for k in p])

    med = stage(middle(long, "m"), "medians")
    groups = med.count()
    off = [F.abs(F.col(v) - F.col(f"m{k}") * SCALE) for k, v in enumerate(VECTOR)]
    mad = middle(_with_groups(vectors, med, groups).select("g", F.posexplode(F.array(*off)).alias("k", "v")), "d")
    spread = [F.sqrt(F.pow(1.4826 * F.col(f"d{k}"), 2) + GRAIN[k] / SURE[k]).alias(f"w{k}") for k in p]
    scales = stage(med.join(mad, "g").select("g", *[f"m{k}" for k in p], *spread), "scales")
    z = _with_groups(vectors, scales, groups).select("g", *[((F.col(v) / SCALE - F.col(f"m{k}")) / F.col(f"w{k}")).alias(f"z{k}") for k, v in enumerate(VECTOR)])
    z = z.withColumn("norm", F.sqrt(sum((F.col(f"z{k}") * F.col(f"z{k}") for k in p), F.lit(1e-12))))
    fixed = lambda x: F.round(x * SCALE).cast("long")
    z = z.select("g", *[fixed(F.tanh(f"z{k}")).alias(f"x{k}") for k in p], *[fixed(F.col(f"z{k}") / F.col("norm")).alias(f"y{k}") for k in p])
    sums = z.groupBy("g").agg(*_products([f"x{k}" for k in p], "x"), *_products([f"y{k}" for k in p], "y"))

    def run(batches):
        for t in batches:
            m, w = (np.stack([t[f"{c}{k}"].to_numpy(float) for k in p], axis=1) for c in "mw")
            for letter in STARTS:
                r = np.zeros((len(t), len(VECTOR), len(VECTOR)))
                if letter != STARTS[0]:
                    r = _square(t, "xy"[STARTS.index(letter) - 1])
                    v = np.sqrt(np.maximum(np.einsum("nkk->nk", r), 1))
                    r = 0.95 * r / (v[:, :, None] * v[:, None, :])  # away from singular
                np.einsum("nkk->nk", r)[:] = 1
                yield _estimate(t["g"] + letter, m, r * w[:, :, None] * w[:, None, :] - np.diag(np.divide(GRAIN, SURE)))

    importable(vectors.sparkSession)
    return scales.join(sums, "g").mapInPandas(run, FIT)


def judge(stats: DataFrame, estimates, lang: str = "lang", source: str = "source", cutoff: float = CUTOFF) -> DataFrame:
    """``stats`` (with STATS) with base_failed, distance and kept.  If the table
    is too small for an estimate, distances are null and the method keeps all."""
    names, fits, n_names = estimates
    own, _ = group_label(lang, source)
    by_label = names.join(fits, "g").drop("g").withColumnRenamed("label", "g")
    rows = _with_groups(stats.select("*", own.alias("g"), *_vector()), by_label, n_names, "left")
    distance = F.sqrt(F.greatest(_distance2(F.col("n_words")), F.lit(0.0)))
    out = rows.withColumn("base_failed", base_failed()).withColumn("distance", distance)
    out = out.withColumn("kept", ~F.col("base_failed") & ~F.coalesce(F.col("distance") > cutoff, F.lit(False)))
    return out.select(*stats.columns, "base_failed", "distance", "kept")


def judge_documents(docs: DataFrame) -> DataFrame:
    """Judge every row of ``documents`` (doc_id, text, lang, source).

    Returns doc_id, STATS, base_failed, kept, distance.  Null texts have no
    words and fail; null languages and sources form groups of their own;
    repeated rows are judged alike; an empty table gives none."""
    stats = stage(add_statistics(docs.select("doc_id", "text", "lang", "source")).drop("text"), "stats")
    return judge(stats, fit_groups(stats)).select("doc_id", *STATS, "base_failed", "kept", "distance")

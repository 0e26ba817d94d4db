"""Operator 3, URL filters: trust and distrust propagated over the host graph.

Written rules (host suffix + path prefix, allow or block) decide the urls that
they fit.  Every other url is judged by its host: personalised PageRank runs
from the hosts that allow rules fit along the links, and from the hosts that
block rules fit against the links (a host that links to blocked hosts earns
distrust).  A host whose distrust outweighs its trust is blocked.

Everything is a Spark expression or join.  Links become host pairs inside the
scan, are counted map-side, and only hosts of the graph take part in the
iterations; the ranks are written to the shared folder between iterations.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from presslake.llm.common import stage

#: (verdict, rule): the rule's text is host suffix, then path prefix.
RULES = (("block", "net/"), ("allow", "example.net/en/"), ("block", "example.com/de/"), ("allow", "org/fr/"))
DAMPING = 0.85
#: Least number of iterations; they go on until no host's rank grows by more than this share of it.
ITERATIONS = 12
TOLERANCE = 1e-6
#: A host is blocked if distrust > RATIO * trust.  The distrust that a host has from blocked pages of
#: its own counts only if they are at least OWN_SHARE of its pages: a rule for a path is not one for its host.
RATIO = 1.0
OWN_SHARE = 0.5
#: Links of a host are dealt over so many tasks.
SALTS = 16

_AZ, _az = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _after_scheme(url: Column) -> Column:
    """What follows the first ``://`` (null or none: empty)."""
    at = F.instr(url, "://")
    return F.when(at > 0, F.substr(url, at + 3)).otherwise(F.lit(""))


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end; A-Z lower-cased."""
    return F.translate(F.regexp_extract(_after_scheme(url), r"^([^/?#]*)", 1), _AZ, _az)


def path_of(url: Column) -> Column:
    """What follows the host, up to ``?``, ``#`` or the end."""
    return F.regexp_extract(_after_scheme(url), r"^[^/?#]*([^?#]*)", 1)


def _best_rule(host: Column, path: Column, rules: Sequence[tuple[str, str]]) -> Column:
    """Struct (rule, verdict) of the longest rule that fits, else null.  Equal
    length (then the rules' hosts differ in depth): the text's order decides."""
    out = F.lit(None).cast("struct<rule:string,verdict:string>")
    for verdict, rule in sorted(rules, key=lambda r: (len(r[1]), r[1])):
        at = rule.index("/")
        suffix, prefix = rule[:at].lower(), rule[at:]
        fits = ((host == F.lit(suffix)) | host.endswith("." + suffix)) & path.startswith(prefix)
        out = F.when(fits, F.struct(F.lit(rule).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(out)
    return out


def links_of(html: Column) -> Column:
    """Hosts of the absolute links (``http://``, ``https://`` or ``//``) of a page."""
    found = F.regexp_extract_all(F.coalesce(html, F.lit("")),
                                 F.lit(r"(?i)<a\s[^>]*?href\s*=\s*[\"']?\s*(?:https?:)?//([^/?#\"'\s>]+)"), F.lit(1))
    return F.transform(found, lambda h: F.translate(h, _AZ, _az))


def propagate(edges: DataFrame, seeds: DataFrame, damping: float = DAMPING,
              iterations: int = ITERATIONS, tolerance: float = TOLERANCE) -> DataFrame:
    """Personalised PageRank of ``kind`` separate walks in the same joins.

    ``edges``: kind, src, dst, w (the weights of a source sum to 1 or less);
    ``seeds``: kind, host, s (sum to 1 per kind).  A walk that reaches a host
    without links ends there.  Each iteration adds the walks that are a link
    longer; the last one added at most ``tolerance`` of its rank to each host,
    and every host that walks reach was reached.
    Returns kind, host, rank of every host reached.
    """
    # A hub's links are dealt over salts; its one rank row is repeated for each.
    edges = stage(edges.withColumn("salt", F.pmod(F.xxhash64("dst"), F.lit(SALTS)).cast("int")), "edges")
    every_salt = F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))
    seeds = stage(seeds, "seeds")
    if edges.isEmpty():
        return seeds.select("kind", "host", F.col("s").alias("rank"))
    # step: what the walks of the last length add; rank: the sum of all steps.
    rank = seeds.select("kind", "host", ((1 - damping) * F.col("s")).alias("rank"), ((1 - damping) * F.col("s")).alias("step"))
    done = 0
    while True:
        going = rank.where("step > 0").select(F.col("kind").alias("k"), F.col("host").alias("h"), "step", every_salt.alias("t"))
        moved = (going.join(edges, (F.col("k") == F.col("kind")) & (F.col("h") == F.col("src")) & (F.col("t") == F.col("salt")))
                 .select("kind", F.col("dst").alias("host"), (damping * F.col("step") * F.col("w")).alias("step")))
        rank = stage(moved.withColumn("rank", F.col("step")).unionByName(rank.withColumn("step", F.lit(0.0)))
                     .groupBy("kind", "host").agg(F.sum("rank").alias("rank"), F.sum("step").alias("step")), "rank")
        done += 1
        growth = rank.agg(F.max(F.col("step") / F.col("rank"))).first()[0]  # one number
        if not growth or (done >= iterations and growth <= tolerance):
            return rank.select("kind", "host", "rank")


def judge_urls(pages: DataFrame, rules: Sequence[tuple[str, str]] = RULES, damping: float = DAMPING,
               iterations: int = ITERATIONS, ratio: float = RATIO, own_share: float = OWN_SHARE) -> DataFrame:
    """Judge every row of ``pages`` (page_id, url, html).

    Returns page_id, host, path, rule, verdict, trust, distrust.  Every host
    of which allow (block) rules fit a page seeds trust (distrust), weighted by
    the share of its pages that they fit.  A host is blocked if its distrust is
    over ``ratio`` times its trust, not counting what it has from blocked pages
    of its own that are less than ``own_share`` of its pages.
    Null or scheme-less urls have host and path empty, fit no rule and are
    allowed, as is a host that no walk reaches.  Null or empty html has no
    links.  Repeated rows are judged alike; an empty table gives none.
    """
    host, path = host_of(F.col("url")), path_of(F.col("url"))
    judged = pages.select("page_id", host.alias("host"), path.alias("path")).withColumn(
        "_r", _best_rule(F.col("host"), F.col("path"), rules))
    # One scan of urls counts the seeds; one of urls and html counts host pairs.
    by_host = (judged.where("host <> ''").groupBy("host").agg(
        F.count("*").alias("pages"), F.count_if(F.col("_r.verdict") == "allow").alias("allow"),
        F.count_if(F.col("_r.verdict") == "block").alias("block")))
    counted = stage(by_host.select("host", "pages", F.expr("stack(2, 'allow', allow, 'block', block) as (kind, n)"))
                    .where("n > 0").select("kind", "host", (F.col("n") / F.col("pages")).alias("n")), "seed-pages")
    totals = counted.groupBy(F.col("kind").alias("k")).agg(F.sum("n").alias("t"))  # two rows
    seeds = counted.join(F.broadcast(totals), F.col("kind") == F.col("k")).select("kind", "host", (F.col("n") / F.col("t")).alias("s"))
    pairs = (pages.select(host.alias("src"), F.explode(links_of(F.col("html"))).alias("dst"))
             .where("src <> '' and dst <> '' and src <> dst").groupBy("src", "dst").agg(F.count("*").alias("n")))
    pairs = stage(pairs, "host-pairs")
    forward = pairs.select(F.lit("allow").alias("kind"), "src", "dst", "n")
    backward = pairs.select(F.lit("block").alias("kind"), F.col("dst").alias("src"), F.col("src").alias("dst"), "n")
    both = forward.unionByName(backward)
    out_n = both.groupBy(F.col("kind").alias("k"), F.col("src").alias("h")).agg(F.sum("n").alias("t"))
    out_n = out_n.withColumn("_t", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    both = both.withColumn("_q", F.pmod(F.xxhash64("dst"), F.lit(SALTS)).cast("int"))
    edges = (both.join(out_n, (F.col("kind") == F.col("k")) & (F.col("src") == F.col("h")) & (F.col("_q") == F.col("_t")))
             .select("kind", "src", "dst", (F.col("n") / F.col("t")).alias("w")))
    rank = propagate(edges, seeds, damping, iterations)
    hosts = rank.groupBy(F.col("host").alias("h")).agg(
        F.sum(F.when(F.col("kind") == "allow", F.col("rank")).otherwise(0.0)).alias("trust"),
        F.sum(F.when(F.col("kind") == "block", F.col("rank")).otherwise(0.0)).alias("distrust"))
    # What a host has from few blocked pages of its own is taken off (and what rounding leaves of it).
    few = (counted.where((F.col("kind") == "block") & (F.col("n") < own_share)).join(F.broadcast(totals), F.col("kind") == F.col("k"))
           .select(F.col("host").alias("o"), ((1 - damping) * F.col("n") / F.col("t")).alias("own")))
    own = F.coalesce("own", F.lit(0.0))
    theirs = F.when(F.col("distrust") > own * (1 + 1e-9), F.col("distrust") - own).otherwise(0.0)
    hosts = stage(hosts.join(few, F.col("h") == F.col("o"), "left").select("h", "trust", "distrust", theirs.alias("theirs")), "host-ranks")
    # Pages take their host's ranks by a join on (host, salt): a hot host's
    # pages spread over the salts, its single row is repeated for each.
    spread = hosts.withColumn("_t", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    left = judged.withColumn("_q", F.pmod(F.xxhash64("page_id", "path"), F.lit(SALTS)).cast("int"))
    bad = F.col("theirs") > ratio * F.col("trust")
    return (left.join(spread, (F.col("host") == F.col("h")) & (F.col("_q") == F.col("_t")), "left")
            .select("page_id", "host", "path", F.col("_r.rule").alias("rule"),
                    F.coalesce(F.col("_r.verdict"), F.when(bad, F.lit("block")).otherwise(F.lit("allow"))).alias("verdict"),
                    F.coalesce("trust", F.lit(0.0)).alias("trust"), F.coalesce("distrust", F.lit(0.0)).alias("distrust")))

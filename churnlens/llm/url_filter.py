"""URL verdicts by rules, and by the purity of each host's path templates where no rule fits.

Everything is a DataFrame expression: no Python worker runs.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from churnlens.llm.salted import salted_join
from churnlens.llm.store import written

# fixed values: the rules (host, path) and their verdicts
RULES = [
    ("org", "/", "allow"),
    ("example.org", "/es/", "block"),
    ("example.org", "/en/1", "block"),
    ("com", "/fr/", "allow"),
    ("com", "/de/", "block"),
]

WILD = "*"
TAIL = "**"
LEVELS = 6          # levels of a template tree; what lies below is one wildcard
LITERAL_SHARE = 20  # a segment stays literal if it leads to 1/20 of its parent's pages or more
BOUND = 1.5         # Hoeffding bound sqrt(ln(2 / alpha) / 2) for alpha = 0.02
WEIGHT = 4          # pages that the prior of a purity counts for
UNIT = 1_000_000    # shares are integers in millionths
EXPECTED_GAP = UNIT // 10  # branches whose prior blocked shares differ by more never merge


def located(pages: DataFrame) -> DataFrame:
    """page_id, host (A-Z lower-cased), path; both empty for a NULL url or one without ``://``."""
    url = F.col("url").cast("string")
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substr(url, at + F.lit(3))).otherwise("")
    rest = F.coalesce(rest, F.lit(""))
    host = F.regexp_extract(rest, r"^[^/?#]*", 0)
    path = F.regexp_extract(F.substr(rest, F.length(host) + F.lit(1)), r"^[^?#]*", 0)
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    return pages.select("page_id", F.translate(host, upper, lower).alias("host"), path.alias("path"))


def rule_of(host: F.Column, path: F.Column, rules: list[tuple[str, str, str]]) -> F.Column:
    """struct(rule, verdict) of the longest rule that fits (equally long: the earlier one), else NULL."""
    best = sorted(rules, key=lambda r: -len(r[0] + r[1]))
    fits = [((host == h) | host.endswith("." + h)) & path.startswith(p) for h, p, _ in best]
    values = [F.struct(F.lit(h + p).alias("rule"), F.lit(v).alias("verdict")) for h, p, v in best]
    return reduce(lambda chain, fv: F.when(fv[0], fv[1]).otherwise(chain), reversed(list(zip(fits, values))),
                  F.lit(None).cast("struct<rule:string,verdict:string>"))


def shapes(urls: DataFrame) -> DataFrame:
    """Adds segments: the path's, from its first ``/`` on, with every run of digits as ``#``."""
    path = F.regexp_replace(F.regexp_replace("path", "^/", ""), "[0-9]+", "#")
    return urls.withColumn("segments", F.when(F.col("path") == "", F.array().cast("array<string>"))
                           .otherwise(F.split(path, "/", -1)))


def _alike(n: str, a: str, m: str, b: str) -> str:
    """a of n and b of m are shares that the Hoeffding bound cannot tell apart (always so without any n or m)."""
    return (f"({n} = 0 or {m} = 0 or abs({a} / nullif({n}, 0) - {b} / nullif({m}, 0))"
            f" <= {BOUND} * (1 / sqrt(nullif({n}, 0)) + 1 / sqrt(nullif({m}, 0))))")


MERGE = " and ".join([
    f"abs(expected / pages - expected_0 / pages_0) <= {EXPECTED_GAP}",
    _alike("labelled", "blocked", "labelled_0", "blocked_0"), _alike("pages", "ended", "pages_0", "ended_0")])
FREQUENT = f"pages > 1 and pages * {LITERAL_SHARE} >= all_pages and not contains(segment, '#')"
COUNTED = ("pages", "ended", "labelled", "blocked", "expected")


def smoothed(blocked: str, labelled: str, prior: str) -> str:
    return f"({UNIT} * {blocked} + {WEIGHT} * {prior}) div ({labelled} + {WEIGHT})"


def literals(level: DataFrame) -> DataFrame:
    """host, prefix, segment, name of the segments that one tree level keeps.

    ``level`` holds host, prefix, segment and the COUNTED columns.  A segment with digits, of a single page,
    or of less than 1/LITERAL_SHARE of its parent's pages is variable and gets no row.  The others, LITERAL_SHARE at
    most a parent, are ordered by their prior blocked share; neighbours merge into one branch, named after all
    its segments, where that share is close and their labelled blocked shares and their shares of
    pages ending there cannot be told apart.
    """
    children = level.groupBy("host", "prefix", "segment").agg(*[F.sum(c).alias(c) for c in COUNTED])
    parents = children.groupBy("host", "prefix").agg(F.sum("pages").alias("all_pages"))
    frequent = (salted_join(children, parents, ["host", "prefix"], ["segment"], "inner")
                .where(FREQUENT))
    ordered = Window.partitionBy("host", "prefix").orderBy(F.expr("expected / pages"), "segment")
    branch = Window.partitionBy("host", "prefix", "branch")
    return (frequent.select("*", *[F.lag(c).over(ordered).alias(f"{c}_0") for c in COUNTED])
            .withColumn("fresh", F.expr(f"case when pages_0 is null or not ({MERGE}) then 1 else 0 end"))
            .withColumn("branch", F.sum("fresh").over(ordered))
            .select("host", "prefix", "segment",
                    F.array_join(F.array_sort(F.collect_list("segment").over(branch)), "|").alias("name")))


def shape_shares(urls: DataFrame) -> DataFrame:
    """host, segments, pages, labelled, blocked, shape_share for every distinct (host, segments) of ``urls``
    (host, segments, verdict of a rule or NULL).

    shape_share is the blocked share of the segment list's labelled pages on all hosts, smoothed towards that
    of all labelled pages.  A hot host comes down to its distinct lists here.
    """
    rows = written(urls.groupBy("host", "segments").agg(
        F.count("*").alias("pages"), F.count("verdict").alias("labelled"),
        F.count_if(F.col("verdict") == "block").alias("blocked")), "paths")
    overall = rows.agg(F.sum("blocked").alias("b"), F.sum("labelled").alias("n")).head()
    share = (UNIT * ((overall.b or 0) + 1)) // ((overall.n or 0) + 2)
    shape = (rows.groupBy("segments").agg(F.sum("blocked").alias("b"), F.sum("labelled").alias("n"))
             .select("segments", F.expr(smoothed("b", "n", str(share))).alias("shape_share")))
    return salted_join(rows, shape, ["segments"], ["host"], "inner")


def templates(rows: DataFrame) -> DataFrame:
    """Adds template to the rows of ``shape_shares``: every host's tree grows one level a round, and each
    round's table is written."""
    rows = written(rows.withColumn("prefix", F.lit("")), "level")
    deepest = rows.agg(F.max(F.size("segments"))).head()[0] or 0
    for i in range(min(deepest, LEVELS)):
        inside = F.size("segments") > i
        rows = rows.withColumn("segment", F.when(inside, F.get("segments", F.lit(i))))
        level = (rows.where(inside)
                 .withColumn("ended", F.when(F.size("segments") == i + 1, F.col("pages")).otherwise(0))
                 .withColumn("expected", F.col("pages") * F.col("shape_share")))
        named = salted_join(rows, literals(level), ["host", "prefix", "segment"], ["segments"])
        longer = F.concat("prefix", F.lit("/"), F.coalesce("name", F.lit(WILD)))
        rows = written(named.withColumn("prefix", F.when(inside, longer).otherwise(F.col("prefix")))
                       .drop("segment", "name"), "level")
    below = F.when(F.size("segments") > LEVELS, F.lit("/" + TAIL)).otherwise("")
    return rows.withColumn("template", F.concat("prefix", below)).drop("prefix")


def purities(rows: DataFrame) -> DataFrame:
    """host, segments, template, blocked_share for the rows of ``templates``: the blocked share of each host's
    template among its labelled pages, smoothed towards its pages' mean shape_share."""
    own = (rows.groupBy("host", "template").agg(
        F.sum("blocked").alias("b"), F.sum("labelled").alias("n"),
        F.expr("sum(pages * shape_share) div sum(pages)").alias("prior"))
        .select("host", "template", F.expr(smoothed("b", "n", "prior")).alias("blocked_share")))
    return (salted_join(rows, own, ["host", "template"], ["segments"], "inner")
            .select("host", "segments", "template", "blocked_share"))


def judge(pages: DataFrame, rules: list[tuple[str, str, str]] = RULES) -> DataFrame:
    """page_id, host, path, rule, verdict, template, blocked_share of every row of ``pages`` (page_id, url; other
    columns are ignored).

    A rule (host, path, verdict) fits its host and all subdomains where the url's path starts with the rule's;
    the longest wins.  Pages that rules decide are the labels.  In each host's tree of path segments, variable
    segments become wildcards and statistically similar branches merge; a page that no rule fits is blocked where
    its template's smoothed blocked share exceeds one half.  blocked_share is in millionths.

    A NULL url and one without ``://`` have an empty host and path, which form a template of their own.  Repeated
    rows and NULL page_ids are judged alike and kept.  Without any labelled page the share is one half and
    nothing is blocked.  An empty table gives an empty result.  Paths are read whole; segments beyond the sixth
    are one wildcard of the template.
    """
    urls = shapes(located(pages)).withColumn("_rule", rule_of(F.col("host"), F.col("path"), rules))
    urls = urls.select("page_id", "host", "path", "segments", F.col("_rule.rule").alias("rule"),
                       F.col("_rule.verdict").alias("verdict"))
    judged = purities(templates(shape_shares(urls)))
    found = salted_join(urls, judged, ["host", "segments"], ["path", "page_id"])
    by_purity = F.when(F.col("blocked_share") > UNIT // 2, "block").otherwise("allow")
    return found.select("page_id", "host", "path", "rule", F.coalesce("verdict", by_purity).alias("verdict"),
                        "template", "blocked_share")

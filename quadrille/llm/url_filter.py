"""URL filter: rules by host and path, and a ratio of character language models for the rest.

URLs that a rule decides train two variable-order Markov models, one of accepted and one of rejected URLs.
The probability of a character after its context is that of the next shorter context, corrected by what was
counted (Witten-Bell): ``(n + t * shorter) / (total + t)``, with ``t`` different characters seen after the
context. A URL that no rule fits is judged by the mean difference of the two log-probabilities over its characters. The
threshold is calibrated on rule-decided URLs left out of the counts, for equal care of both kinds.

Everything is DataFrame operations: n-grams are counted over all URLs, each probability is found once for a
distinct n-gram, and only those are joined with the characters of the URLs.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quadrille.session import stage

ORDER = 5
#: Probability of a character of which nothing is known.
UNKNOWN = 1 / 256
#: One in so many rule-decided URLs calibrates instead of being counted.
HELD_OUT = 5
PAD = "\u0002"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

Rule = tuple[str, str, str]


def after_scheme(url: Column) -> Column:
    """What stands behind the first ``://``; empty if there is none."""
    at = F.instr(url, "://")
    return F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")


def host_of(url: Column) -> Column:
    return F.translate(F.regexp_extract(after_scheme(url), r"^[^/?#]*", 0), UPPER, LOWER)


def path_of(url: Column) -> Column:
    return F.regexp_extract(after_scheme(url), r"^[^/?#]*([^?#]*)", 1)


def _fits(rule: Rule) -> Column:
    _, host, path = rule
    return ((F.col("host") == host) | F.endswith("host", F.lit("." + host))) & F.startswith("path", F.lit(path))


def _decided(rules: list[Rule]) -> tuple[Column, Column]:
    """Verdict and text of the longest rule that fits ``host`` and ``path``."""
    none = F.lit(None).cast("string")
    ordered = sorted(rules, key=lambda r: (-len(r[1] + r[2]), r))
    verdict = reduce(lambda rest, r: F.when(_fits(r), r[0]).otherwise(rest), reversed(ordered), none)
    text = reduce(lambda rest, r: F.when(_fits(r), r[1] + r[2]).otherwise(rest), reversed(ordered), none)
    return verdict, text


def _grams(urls: DataFrame) -> DataFrame:
    """One row for each character of a URL, with the ``ORDER`` characters before it."""
    padded = F.concat(F.lit(PAD * ORDER), "chars")
    grams = F.transform(F.sequence(F.lit(1), F.length("chars")), lambda i: F.substring(padded, i, F.lit(ORDER + 1)))
    return urls.where(F.length("chars") > 0).withColumn("gram", F.explode(grams)).drop("chars")


def _probabilities(grams: DataFrame) -> DataFrame:
    """``gram, ratio``: the log-probability of the last character when accepted, less that when rejected.

    ``grams`` has ``gram, accepted, rejected``: each distinct n-gram with its counts.
    """
    below = None
    for k in range(ORDER + 1):
        level = grams.groupBy(F.substring("gram", ORDER + 1 - k, k + 1).alias("gram")).agg(
            F.sum("accepted").alias("accepted"), F.sum("rejected").alias("rejected"))
        # A context has at most as many rows as there are characters.
        context = Window.partitionBy(F.substring("gram", 1, k))
        level = level.withColumns({
            f"{kind}_{what}": f.over(context) for kind in ("accepted", "rejected")
            for what, f in (("total", F.sum(kind)), ("kinds", F.sum((F.col(kind) > 0).cast("long"))))})
        if below is None:
            level = level.withColumns({"accepted_p": F.lit(UNKNOWN), "rejected_p": F.lit(UNKNOWN)})
        else:
            level = level.withColumn("shorter", F.substring("gram", 2, k)).join(
                below.withColumnRenamed("gram", "shorter"), "shorter").drop("shorter")
        below = level.select("gram", *(
            F.when(F.col(f"{kind}_total") == 0, F.col(f"{kind}_p"))
            .otherwise((F.col(kind) + F.col(f"{kind}_kinds") * F.col(f"{kind}_p"))
                       / (F.col(f"{kind}_total") + F.col(f"{kind}_kinds"))).alias(f"{kind}_p")
            for kind in ("accepted", "rejected")))
    return below.select("gram", (F.ln("accepted_p") - F.ln("rejected_p")).alias("ratio"))


def _threshold(scores: DataFrame) -> float:
    """Where the mean of both error rates is least; the middle if several. Scores are counted in hundredths."""
    bins = scores.groupBy(F.floor(F.col("score") * 100).alias("bin")).agg(
        F.sum((F.col("verdict") == "allow").cast("long")).alias("allow"),
        F.sum((F.col("verdict") == "block").cast("long")).alias("block")).orderBy("bin").collect()
    allow, block = sum(r["allow"] for r in bins), sum(r["block"] for r in bins)
    if not allow or not block:
        return 0.0
    best, at, missed, passed = None, [], 0, block
    for r in bins:
        error = missed / allow + passed / block
        if best is None or error < best - 1e-12:
            best, at = error, []
        if error <= best + 1e-12:
            at.append(r["bin"])
        missed, passed = missed + r["allow"], passed - r["block"]
    return at[len(at) // 2] / 100


def url_filter(pages: DataFrame, rules: list[Rule]) -> DataFrame:
    """``page_id, host, path, rule, verdict, score`` of each page, ``verdict`` being ``allow`` or ``block``.

    ``rules`` are ``(verdict, host, path)``: a rule fits its host and all subdomains if the path begins with
    the rule's; the longest that fits decides, and ``rule`` is its text. Else ``rule`` is NULL, and ``score``, the
    mean log-likelihood difference, decides: ``allow`` from the calibrated threshold on. ``score`` is NULL
    where a rule decides.

    A NULL URL or one without ``://`` has an empty host and path and the score 0. Repeated rows and rows
    without ``page_id`` are judged like any other. Other columns are ignored. If rules decide no URL of a kind, the
    model of that kind knows nothing and the threshold is 0. An empty table gives an empty result.
    """
    url = F.coalesce(F.col("url").cast("string"), F.lit(""))
    verdict, text = _decided(rules)
    judged = (
        pages.select("page_id", url.alias("url")).withColumns({"host": host_of(F.col("url")), "path": path_of(F.col("url"))})
        .withColumns({"verdict": verdict, "rule": text})
    )
    chars = F.concat("host", F.substring(after_scheme(F.col("url")), F.length("host") + 1, F.length("url")))
    urls = judged.select("url", chars.alias("chars"), "verdict").distinct()
    urls = stage(urls.withColumn(
        "counts", F.col("verdict").isNotNull() & (F.pmod(F.xxhash64("url"), F.lit(HELD_OUT)) != 0)), "urls")
    counts = _grams(urls).groupBy("gram").agg(
        F.sum((F.col("counts") & (F.col("verdict") == "allow")).cast("long")).alias("accepted"),
        F.sum((F.col("counts") & (F.col("verdict") == "block")).cast("long")).alias("rejected"))
    counts = counts.select("gram", F.coalesce("accepted", F.lit(0)).alias("accepted"),
                           F.coalesce("rejected", F.lit(0)).alias("rejected"))
    ratios = stage(_probabilities(stage(counts, "grams")), "ratios")
    scores = (
        _grams(urls.where(~F.col("counts"))).groupBy("url", "verdict", "gram").agg(F.count("*").alias("n"))
        .join(ratios, "gram").groupBy("url", "verdict")
        .agg((F.sum(F.col("n") * F.col("ratio")) / F.sum("n")).alias("score"))
    )
    scores = stage(scores, "scores")
    threshold = _threshold(scores.where("verdict is not null"))
    found = judged.join(scores.where("verdict is null").select("url", "score"), "url", "left")
    score = F.when(F.col("rule").isNull(), F.coalesce("score", F.lit(0.0)))
    return found.select(
        "page_id", "host", "path", "rule",
        F.coalesce("verdict", F.when(score >= threshold, "allow").otherwise("block")).alias("verdict"),
        score.alias("score"))

"""URL filters: rules where they fit, trust and distrust along host links elsewhere.

Pages that an allow rule fits make their host a trusted seed, those that a block rule fits a
blocked one. Personalised PageRank spreads trust from trusted hosts along links, and distrust
from blocked hosts against them: who links to a blocked host is suspect. A page without a
rule is blocked when its host's distrust outweighs its trust.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textloom.operators.joins import fits_broadcast
from textloom.session import materialize

DAMPING = 0.85
SETTLED = 1e-9  # the largest change of a host's mass in a round, as a share of it, at which spreading ends
TIE = 1e-6  # shares by which trust and distrust must differ; above what SETTLED leaves open
THRESHOLD = 1.0  # distrust may be this many times the trust before a host is blocked


@dataclass(frozen=True)
class Rule:
    verdict: str  # allow or block
    host: str
    path: str

    @property
    def name(self) -> str:
        return self.host + self.path


def _after_scheme(url: Column) -> Column:
    at = F.instr(url, "://")
    return F.when(at > 0, F.substring(url, at + 3, F.length(url)))


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z in lower case; empty
    where the url is null or has no ``://``."""
    host = F.regexp_extract(_after_scheme(url), r"^([^/?#]*)", 1)
    return F.coalesce(F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), F.lit(""))


def path_of(url: Column) -> Column:
    """What follows the host, up to ``?``, ``#`` or the end."""
    return F.coalesce(F.regexp_extract(_after_scheme(url), r"^[^/?#]*([^?#]*)", 1), F.lit(""))


def _fits(rule: Rule) -> Column:
    own = F.col("host") == rule.host
    below = F.endswith(F.col("host"), F.lit("." + rule.host))
    return (own | below) & F.startswith(F.col("path"), F.lit(rule.path))


def fitting_rule(rules: Sequence[Rule]) -> Column:
    """The longest fitting rule as a struct of its name and verdict, or null. Of equally
    long ones the last in the list wins."""
    chosen = F.lit(None).cast("struct<rule:string,verdict:string>")
    for rule in sorted(rules, key=lambda rule: len(rule.name)):
        value = F.struct(F.lit(rule.name).alias("rule"), F.lit(rule.verdict).alias("verdict"))
        chosen = F.when(_fits(rule), value).otherwise(chosen)
    return chosen


def host_links(pages: DataFrame) -> DataFrame:
    """``(src, dst, n)``: links between different hosts, with how many pages hold them.

    An address without a scheme stays on its own host and makes no edge; ``//host/`` does.
    Links of one page to one host count once. Counts are combined before the shuffle.
    """
    marked = F.regexp_extract_all(
        F.coalesce("html", F.lit("")),
        F.lit(r"""(?i)<a\s(?:[^>]*?\s)?href\s*=\s*["']?\s*((?:https?:)?//[^"'\s>]+)"""),
        F.lit(1),
    )
    targets = F.array_distinct(
        F.transform(marked, lambda link: host_of(F.regexp_replace(link, r"^//", "http://")))
    )
    return (
        pages.select(host_of(F.col("url")).alias("src"), F.explode(targets).alias("dst"))
        .where("src != '' and dst != '' and src != dst")
        .groupBy("src", "dst")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def _looked_up(rows: DataFrame, table: DataFrame, key: str) -> DataFrame:
    """One value per host: broadcast where it is measured to be small."""
    return rows.join(F.broadcast(table) if fits_broadcast(table) else table, key, "left")


def spread(edges: DataFrame, seeds: DataFrame, rounds: int | None = None, damping: float = DAMPING) -> DataFrame:
    """``(host, mass)``: personalised PageRank over ``edges(src, dst, n)`` from
    ``seeds(host, mass)``, after a fixed number of rounds or, with none given, when it has settled.

    It has settled when no host's mass changed by more than ``SETTLED`` of itself. Small masses count
    like large ones, and a host that is reached for the first time has changed by all of its
    mass, so hosts at any distance are reached. The share that a round changes never grows
    again, and all masses together change by 0.85 of the last change at most, so it ends.

    Each edge carries its share of its source's links. Mass of a host without links returns to
    the seeds only through the restart, so masses need not add up to 1; only their order
    of size matters here. Every round is written down, so a lost executor repeats one round.
    """
    total = seeds.agg(F.sum("mass")).first()[0] or 1.0
    start = materialize(seeds.select("host", (F.col("mass") / F.lit(total)).alias("mass")), "seeds")
    out = edges.groupBy("src").agg(F.sum("n").alias("_out"))
    shares = materialize(
        _looked_up(edges, out, "src").select("src", "dst", (F.col("n") / F.col("_out")).alias("share")), "host-shares"
    )
    mass = start
    if shares.isEmpty():
        return mass
    none = F.lit(0.0)
    restart = start.select("host", (F.col("mass") * (1.0 - damping)).alias("mass"), none.alias("before"))
    done = 0
    while rounds is None or done < rounds:
        moved = (
            _looked_up(shares, mass.withColumnRenamed("host", "src"), "src")
            .where("mass is not null")
            .select(
                F.col("dst").alias("host"), (F.col("mass") * F.col("share") * damping).alias("mass"), none.alias("before")
            )
        )
        held = mass.select("host", none.alias("mass"), F.col("mass").alias("before"))
        after = materialize(
            moved.unionByName(restart).unionByName(held).groupBy("host").agg(
                F.sum("mass").alias("mass"), F.sum("before").alias("before")
            ),
            "host-mass",
        )
        mass, done = after.select("host", "mass"), done + 1
        if rounds is None and after.where(F.abs(F.col("mass") - F.col("before")) > F.col("mass") * SETTLED).isEmpty():
            break
    return mass


def host_scores(pages: DataFrame, judged: DataFrame, rounds: int | None = None) -> DataFrame:
    """``(host, trust, distrust)`` of every host that a seed reaches.

    ``judged`` are ``(host, verdict)`` rows, one per page with a rule; a host's seed mass is its
    number of such pages.
    """
    edges = materialize(host_links(pages), "host-links")
    against = edges.select(F.col("dst").alias("src"), F.col("src").alias("dst"), "n")
    seeds = materialize(
        judged.where("host != ''").groupBy("host").agg(
            F.count_if(F.col("verdict") == "allow").cast("double").alias("trusted"),
            F.count_if(F.col("verdict") == "block").cast("double").alias("blocked"),
        ),
        "host-seeds",
    )
    trust = spread(edges, seeds.where("trusted > 0").select("host", F.col("trusted").alias("mass")), rounds)
    distrust = spread(against, seeds.where("blocked > 0").select("host", F.col("blocked").alias("mass")), rounds)
    return (
        trust.select("host", F.col("mass").alias("trust"), F.lit(0.0).alias("distrust"))
        .unionByName(distrust.select("host", F.lit(0.0).alias("trust"), F.col("mass").alias("distrust")))
        .groupBy("host")
        .agg(F.sum("trust").alias("trust"), F.sum("distrust").alias("distrust"))
    )


def _digits(mass: Column) -> Column:
    """Rounded to 9 significant digits."""
    return F.format_string("%.8e", mass).cast("double")


def url_verdicts(
    pages: DataFrame, rules: Sequence[Rule], rounds: int | None = None, threshold: float = THRESHOLD
) -> DataFrame:
    """``(page_id, host, path, rule, verdict, trust, distrust)``, one row per page.

    ``pages(page_id, url, html, ...)``; a null url, or one without ``://``, has empty host and
    path, fits no rule and is allowed, as is every page whose host neither seed reaches. A
    null html has no links. Repeated rows are judged each; other columns are not looked at.
    Distrust must be more than trust by a share of ``TIE``, however small both are; a tie allows.
    Scores are given to 9 significant digits.
    """
    chosen = fitting_rule(rules)
    parts = pages.select(
        "page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path")
    ).withColumn("chosen", chosen)
    scores = materialize(
        host_scores(pages, parts.where("chosen is not null").select("host", "chosen.verdict"), rounds), "host-scores"
    )
    trust = F.coalesce("trust", F.lit(0.0))
    distrust = F.coalesce("distrust", F.lit(0.0))
    method = F.when(distrust > trust * threshold * (1.0 + TIE), "block").otherwise("allow")
    return _looked_up(parts, scores, "host").select(
        "page_id",
        "host",
        "path",
        F.col("chosen.rule").alias("rule"),
        F.coalesce(F.col("chosen.verdict"), method).alias("verdict"),
        _digits(trust).alias("trust"),
        _digits(distrust).alias("distrust"),
    )

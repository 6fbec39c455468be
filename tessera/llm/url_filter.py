"""URL filters: host and path rules, and empirical-Bayes host reputation.

Labelled page outcomes are counted per host. The bad rate of a suffix shrinks
towards all pages, that of a registered domain towards the rest of its suffix,
that of a host towards the rest of its domain, each through a mixture of beta
priors of different strength; how common each strength is at a level is estimated
from its members' likelihoods, one vote a member. A host is blocked when the lower
bound of its posterior bad rate passes a limit."""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import persist

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: Suffixes of two labels under which domains are registered; a parameter.
TWO_LABEL_SUFFIXES = ("ac.uk", "co.jp", "co.nz", "co.uk", "com.au", "com.br", "gov.uk", "ne.jp", "org.au", "org.uk")
BLOCK_ABOVE = 0.5       # bad rate that a host may have
Z = 1.645               # standard deviations between the posterior mean and its bound
WEAKEST, STRONGEST = 2.0, 10_000.0  # limits of a prior's strength, in labelled pages
STRENGTHS = tuple(WEAKEST * (STRONGEST / WEAKEST) ** (j / 9) for j in range(10))
ROUNDS = 8              # of expectation maximisation


@dataclass(frozen=True)
class Rule:
    host: str
    path: str
    verdict: str  # allow or block

    @property
    def name(self) -> str:
        return self.host + self.path


def rule(text: str, verdict: str) -> Rule:
    host, slash, path = text.partition("/")
    return Rule(host, slash + path, verdict)


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; else empty."""
    return F.translate(F.regexp_extract(_rest(url), "^[^/?#]*", 0), UPPER, UPPER.lower())


def path_of(url: Column) -> Column:
    """After the host up to ``?``, ``#`` or the end; else empty."""
    return F.regexp_extract(_rest(url), "^[^/?#]*([^?#]*)", 1)


def _rest(url: Column) -> Column:
    at = F.instr(url, "://")
    return F.coalesce(F.when(at > 0, F.substr(url, at + 3)), F.lit(""))


def matching_rule(host: Column, path: Column, rules: Sequence[Rule]) -> Column:
    """Struct ``(name, verdict)`` of the longest rule that fits, else null: the
    rule's host or a subdomain of it, and a path that starts with the rule's."""
    found = F.lit(None).cast("struct<name:string,verdict:string>")
    for r in sorted(rules, key=lambda r: (len(r.name), r.name)):
        fits = ((host == r.host) | F.endswith(host, F.lit(f".{r.host}"))) & F.startswith(path, F.lit(r.path))
        found = F.when(fits, F.struct(F.lit(r.name).alias("name"), F.lit(r.verdict).alias("verdict"))).otherwise(found)
    return found


def domain_of(host: Column, two_label: Sequence[str] = TWO_LABEL_SUFFIXES) -> Column:
    """Registered domain: the last two labels of the host without port, or three
    under a two-label suffix; numeric addresses stand for themselves."""
    bare = F.regexp_replace(F.regexp_replace(host, "^.*@", ""), ":[0-9]*$", "")
    two = F.substring_index(bare, ".", -2)
    return F.when(F.regexp_like(bare, F.lit(r"^[0-9.]+$|^\[")), bare).when(
        two.isin(*two_label), F.substring_index(bare, ".", -3)).otherwise(two)


def suffix_of(domain: Column) -> Column:
    at = F.instr(domain, ".")
    return F.when(F.regexp_like(domain, F.lit(r"^[0-9.]+$|^\[")), F.lit("")).when(
        at > 0, F.substr(domain, at + 1)).otherwise(domain)


def _lgamma(x: Column) -> Column:
    """Logarithm of the gamma function for x > 0: Stirling's series at x + 7."""
    y, product = x + 7, x
    for i in range(1, 7):
        product = product * (x + i)
    series = (F.lit(1 / 12) - (F.lit(1 / 360) - F.lit(1 / 1260) / (y * y)) / (y * y)) / y
    return (y - 0.5) * F.log(y) - y + 0.5 * math.log(2 * math.pi) + series - F.log(product)


def _scored(level: DataFrame, weights: Sequence[float]) -> DataFrame:
    """``level(n, k, prior)`` with ``scores``: for every strength the logarithm of
    its weight times the beta-binomial likelihood of the counts, and their ``top``."""
    n, k, m = F.col("n").cast("double"), F.col("k").cast("double"), F.col("prior")

    def likelihood(x: Column) -> Column:
        s = x["s"]
        a, b = s * m, s * (1 - m)
        return x["w"] + _lgamma(k + a) - _lgamma(a) + _lgamma(n - k + b) - _lgamma(b) + _lgamma(s) - _lgamma(s + n)

    grid = F.array(*[F.struct(F.lit(s).alias("s"), F.lit(math.log(w)).alias("w")) for s, w in zip(STRENGTHS, weights, strict=True)])
    return level.withColumn("scores", F.transform(grid, likelihood)).withColumn("top", F.array_max("scores"))


def _weights(level: DataFrame, name: str) -> list[float]:
    """How common every strength is among the members of ``level(n, k, prior)``
    with labelled pages, by ``ROUNDS`` of expectation maximisation. A member counts
    once however many pages it has, so a hot host fixes nothing for the others; one
    member more is spread evenly, so no strength is impossible."""
    many = len(STRENGTHS)
    even = [1 / many] * many
    scored = persist(_scored(level.where("n > 0").select("n", "k", "prior"), even).select(
        *[F.exp(F.col("scores")[j] - F.col("top")).alias(f"l{j}") for j in range(many)]), f"url-likely-{name}")
    weights = even
    for _ in range(ROUNDS):
        total = reduce(add, [F.col(f"l{j}") * w for j, w in enumerate(weights)])
        r = scored.agg(F.count("*").alias("members"), *[F.coalesce(F.sum(F.col(f"l{j}") * w / total), F.lit(0.0)).alias(f"r{j}")
                                                        for j, w in enumerate(weights)]).first()
        weights = [(r[f"r{j}"] + 1 / many) / (r.members + 1) for j in range(many)]
    return weights


def _posterior(level: DataFrame, weights: Sequence[float]) -> DataFrame:
    """``level(n, k, prior)`` with ``rate`` and ``sd`` of the posterior over the
    mixture: counts that a strong prior cannot explain speak for a weak one."""
    n, k, m, top = F.col("n"), F.col("k"), F.col("prior"), F.col("top")
    strengths = F.array(*[F.lit(s) for s in STRENGTHS])

    def mean(of) -> Column:
        parts = F.zip_with("scores", strengths, lambda x, s: F.exp(x - top) * of((k + s * m) / (n + s), s))
        return F.aggregate(parts, F.lit(0.0), lambda x, y: x + y)

    rated = _scored(level, weights).withColumn("total", mean(lambda r, s: F.lit(1.0))).withColumn(
        "rate", mean(lambda r, s: r) / F.col("total"))
    rate = F.col("rate")
    spread = mean(lambda r, s: (r - rate) * (r - rate) + r * (1 - r) / (n + s + 1)) / F.col("total")
    return rated.withColumn("sd", F.sqrt(spread)).drop("scores", "top", "total")


def _with_prior(level: DataFrame, above: DataFrame, key: str) -> DataFrame:
    """``level`` with the ``prior`` that the level above gives: the posterior rate of
    its other members, so that no count is evidence twice."""
    weights = _weights(above, key)
    up = above.select(key, F.col("n").alias("up_n"), F.col("k").alias("up_k"), "prior")
    own = level.withColumnsRenamed({"n": "own_n", "k": "own_k"}).join(up, key)
    rest = own.withColumn("n", F.col("up_n") - F.col("own_n")).withColumn("k", F.col("up_k") - F.col("own_k"))
    return (_posterior(rest, weights).drop("n", "k", "up_n", "up_k", "prior", "sd")
            .withColumnsRenamed({"own_n": "n", "own_k": "k", "rate": "prior"}))


def reputation(hosts: DataFrame, outcomes: DataFrame, z: float = Z) -> DataFrame:
    """``(host, n, k, rate, bound)`` for every row of ``hosts(host)`` from
    ``outcomes(host, n, k)`` (labelled and bad pages). ``rate`` is the posterior
    mean, ``bound`` lies ``z`` posterior standard deviations below it. A host
    without labelled pages has its domain's rate, and so on upwards; without
    any labels all rates are one half and the bound is far below.

    Counts meet by aggregation only; each level reads the one below, written.
    """
    known = (hosts.join(outcomes, "host", "left")
             .select("host", F.coalesce("n", F.lit(0)).alias("n"), F.coalesce("k", F.lit(0)).alias("k"),
                     domain_of(F.col("host")).alias("domain")).withColumn("suffix", suffix_of(F.col("domain"))))
    known = persist(known, "url-hosts")
    domains = persist(known.groupBy("domain", "suffix").agg(F.sum("n").alias("n"), F.sum("k").alias("k")), "url-domains")
    suffixes = domains.groupBy("suffix").agg(F.sum("n").alias("n"), F.sum("k").alias("k"))
    all_pages = domains.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.coalesce(F.sum("k"), F.lit(0)).alias("k")).first()
    suffixes = persist(suffixes.withColumn("prior", F.lit((all_pages.k + 0.5) / (all_pages.n + 1.0))), "url-suffixes")
    domains = persist(_with_prior(domains, suffixes, "suffix"), "url-rated-domains")
    known = persist(_with_prior(known, domains, "domain"), "url-rated-hosts")
    rated = _posterior(known, _weights(known, "host"))
    return rated.select("host", "n", "k", "rate", (F.col("rate") - z * F.col("sd")).alias("bound"))


def page_outcomes(pages: DataFrame, labels: DataFrame, id_col: str = "page_id", label_id: str = "doc_id") -> DataFrame:
    """``(host, n, k)`` from ``pages(<id_col>, host)``: labelled pages and bad
    ones. A page is bad if any label of it says toxic, or not good quality; a
    label row without both, or without an id, is none."""
    verdicts = (labels.select(F.col(label_id).alias("id"), F.greatest((F.col("toxic") > 0).cast("int"),
                                                                       (F.col("quality") <= 0).cast("int")).alias("bad"))
                .where("id IS NOT NULL AND bad IS NOT NULL").groupBy("id").agg(F.max("bad").alias("bad")))
    return (pages.select(F.col(id_col).alias("id"), "host").where("host <> ''").join(verdicts, "id")
            .groupBy("host").agg(F.count("*").alias("n"), F.sum("bad").alias("k")))


def judge(pages: DataFrame, labels: DataFrame, rules: Sequence[Rule], id_col: str = "page_id", url_col: str = "url",
          block_above: float = BLOCK_ABOVE, z: float = Z) -> DataFrame:
    """One row per page: ``id, host, path, rule, verdict, rate, bound``. The
    longest rule that fits decides; else a host whose posterior bound of the
    bad rate is above ``block_above`` is blocked. A null URL or one without
    ``://`` has empty host and path, which no host reputation covers: allowed.
    Repeated rows each come back; empty tables give no rows.

    The host table has one row per host, so the join back to pages has a small
    side, and a host with a third of all pages is split by AQE or broadcast.
    """
    url = F.col(url_col).cast("string")
    seen = pages.select(F.col(id_col).alias("id"), host_of(url).alias("host"), path_of(url).alias("path"))
    hosts = seen.where("host <> ''").groupBy("host").agg(F.count("*").alias("pages")).select("host")
    rated = reputation(hosts, page_outcomes(seen, labels, "id"), z).select("host", "rate", "bound")
    judged = seen.join(persist(rated, "url-reputation"), "host", "left").withColumn(
        "fit", matching_rule(F.col("host"), F.col("path"), rules))
    learned = F.when(F.col("bound") > block_above, "block").otherwise("allow")
    return judged.select("id", "host", "path", F.col("fit.name").alias("rule"),
                         F.coalesce("fit.verdict", learned).alias("verdict"), "rate", "bound")

"""URL filters: explicit rules first, then the reputation of the host.

Labelled page outcomes (1 good, 0 bad) are counted per host, registered domain and suffix. Each
level is a beta-binomial whose prior is its parent: a suffix is shrunk towards the overall rate,
a domain towards its suffix, a host towards its domain. How strongly is estimated from the data
(empirical Bayes, by moments): the less the children of a parent differ, the more they borrow.
A host is blocked when even the upper bound of its posterior good rate is below what is asked for: a
share of the rate of all labelled pages, so that hosts far below the rest go also where nearly all
is good, and never less than `least_good`.

A suffix may have two labels (`co.uk`), by a list that is a parameter. Ports are left out of domains,
and an address of numbers is a domain of its own.

All of it is aggregation, combined in the map tasks, over narrow rows; a host that holds a third of
all pages is one row of the reputation table. Pages find their host's row by a join that
broadcasts the table if it was counted to be small, and is split where skewed otherwise.

Defined cases: a url that is null or without `://` has an empty host and path, and the empty host
has a reputation like any other. Without labelled pages nothing is blocked by reputation. Labels
that are null are left out; repeated labels count each. Repeated pages are judged each for itself.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from blotter.llm.common import checkpointed, small_enough

# The rules (verdict, host and path) of the registered query.
RULES = (
    ("block", "net/"),
    ("allow", "example.net/en/"),
    ("block", "example.com/de/"),
    ("allow", "org/fr/"),
)

# A host is blocked if its good rate is below this, so far as its posterior can tell,
LEAST_GOOD = 0.5
# or below this share of the rate of all labelled pages.
LEAST_SHARE = 0.8
# The bound lies this many posterior standard deviations above the mean.
BOUND_SD = 1.645

# Common suffixes of two labels under which names are registered.
SUFFIXES = (
    "ac.jp", "ac.uk", "ac.za", "co.id", "co.il", "co.in", "co.jp", "co.ke", "co.kr", "co.nz", "co.th",
    "co.uk", "co.za", "com.ar", "com.au", "com.bd", "com.br", "com.cn", "com.co", "com.eg", "com.hk",
    "com.mx", "com.my", "com.ng", "com.pe", "com.ph", "com.pk", "com.pl", "com.sa", "com.sg", "com.tr",
    "com.tw", "com.ua", "com.ve", "com.vn", "edu.au", "edu.cn", "gob.mx", "gov.au", "gov.br", "gov.cn",
    "gov.in", "gov.uk", "ltd.uk", "me.uk", "ne.jp", "net.au", "net.br", "net.cn", "net.nz", "net.uk",
    "or.jp", "or.kr", "org.ar", "org.au", "org.br", "org.cn", "org.in", "org.mx", "org.nz", "org.tr",
    "org.tw", "org.uk", "org.za", "plc.uk", "sch.uk",
)

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_and_path(url: Column) -> tuple[Column, Column]:
    place = F.instr(url, "://")
    rest = F.when(place > 0, F.substring(url, place + 3, F.length(url))).otherwise(F.lit(""))
    rest = F.coalesce(rest, F.lit(""))
    host = F.regexp_extract(rest, r"^[^/?#]*", 0)
    path = F.regexp_extract(F.substring(rest, F.length(host) + 1, F.length(rest)), r"^[^?#]*", 0)
    return F.translate(host, UPPER, LOWER), path


def longest_rule(host: Column, path: Column, rules: Sequence[tuple[str, str]], value: int) -> Column:
    """The verdict (value 0) or the text (1) of the longest rule that fits, else null."""
    found = None
    for rule in sorted(rules, key=lambda r: len(r[1]), reverse=True):
        name, slash, rest = rule[1].partition("/")
        fits = ((host == name) | host.endswith("." + name)) & path.startswith(slash + rest)
        found = F.when(fits, rule[value]) if found is None else found.when(fits, rule[value])
    return F.lit(None).cast("string") if found is None else found


def _last(name: Column, labels: int) -> Column:
    return F.substring_index(name, ".", -labels)


def registered_domain(host: Column, suffixes: Sequence[str] = SUFFIXES) -> Column:
    """The suffix of a host and the label before it."""
    name = F.regexp_replace(host, ":[0-9]*$", "")
    number = name.rlike(r"^[0-9]+(\.[0-9]+){3}$")
    two = _last(name, 2).isin(list(suffixes))
    return F.when(number, name).when(two, _last(name, 3)).otherwise(_last(name, 2))


def suffix(domain: Column, suffixes: Sequence[str] = SUFFIXES) -> Column:
    """The suffix of a registered domain; that of an address of numbers is empty."""
    number = domain.rlike(r"^[0-9]+(\.[0-9]+){3}$")
    two = _last(domain, 2).isin(list(suffixes))
    return F.when(number, F.lit("")).when(two, _last(domain, 2)).otherwise(_last(domain, 1))


def _strength(children: DataFrame, parent: str) -> DataFrame:
    """One row: how many outcomes the prior of a child counts for, from children (parent, n, good).

    The variance of the children's rates around their parent's, beyond what chance gives, is the
    correlation of outcomes within a child; strength is 1 / correlation - 1.
    """
    n, good = F.col("n"), F.col("good")
    whole = children.where(n > 0).groupBy(parent).agg(
        F.sum(n).alias("N"),
        (F.sum(good) / F.sum(n)).alias("p"),
        F.sum(good * good / n).alias("gg"),
        (F.sum(n * n) / F.sum(n)).alias("nn"),
        (F.count(F.lit(1)) - 1).alias("free"),
    )
    spread = F.col("gg") - F.col("N") * F.col("p") * F.col("p")  # sum of n (rate - p)^2
    chance = F.col("p") * (1 - F.col("p"))
    beyond = F.sum(spread - chance * F.col("free"))
    most = F.sum(chance * (F.col("N") - F.col("nn") - F.col("free")))
    rho = F.when(most > 0, F.least(F.greatest(beyond / most, F.lit(0.001)), F.lit(0.999)))
    return whole.agg((1 / F.coalesce(rho, F.lit(0.001)) - 1).alias("strength"))


def reputation(hosts: DataFrame) -> DataFrame:
    """host, mean and bound of its posterior good rate, and the rate of all, from hosts (host, n, good).

    `hosts` has a row for every host, with n = 0 where no page of it is labelled.
    """
    n, good = F.col("n"), F.col("good")
    sums = [F.sum(n).alias("n"), F.sum(good).alias("good")]
    hosts = hosts.select("host", registered_domain(F.col("host")).alias("domain"), "n", "good")
    domains = hosts.groupBy("domain").agg(*sums).withColumn("suffix", suffix(F.col("domain")))
    suffixes = domains.groupBy("suffix").agg(*sums).withColumn("all", F.lit(1))
    overall = suffixes.groupBy("all").agg(*sums)
    rate = F.when(n > 0, good / n).otherwise(F.lit(0.5))
    mean = (good + F.col("strength") * F.col("prior")) / (n + F.col("strength"))

    # The strengths and the overall rate are one row each.
    top = suffixes.drop("all").join(F.broadcast(overall.select(rate.alias("prior"))))
    top = top.join(F.broadcast(_strength(suffixes, "all"))).select("suffix", mean.alias("prior"))
    middle = domains.join(top, "suffix").join(F.broadcast(_strength(domains, "suffix")))
    middle = middle.select("domain", mean.alias("prior"))
    bottom = hosts.join(middle, "domain").join(F.broadcast(_strength(hosts, "domain")))
    weight = n + F.col("strength")
    sd = F.sqrt(mean * (1 - mean) / (weight + 1))
    found = bottom.select(
        "host", mean.alias("mean"), F.least(mean + BOUND_SD * sd, F.lit(1.0)).alias("bound")
    )
    return found.join(F.broadcast(overall.select(rate.alias("overall"))))  # one row


def judge_pages(
    pages: DataFrame,
    labels: DataFrame,
    rules: Sequence[tuple[str, str]] = RULES,
    least_good: float = LEAST_GOOD,
    least_share: float = LEAST_SHARE,
) -> DataFrame:
    """page_id, host, path, rule, verdict, and mean and bound of the host's reputation.

    `pages` has page_id and url, `labels` page_id and good (1, 0 or null).
    """
    host, path = host_and_path(F.col("url"))
    parsed = pages.select("page_id", host.alias("host"), path.alias("path"))
    outcomes = (
        parsed.select("page_id", "host")
        .join(labels.where(F.col("good").isNotNull()).select("page_id", "good"), "page_id")
        .groupBy("host")
        .agg(F.count(F.lit(1)).alias("n"), F.sum("good").alias("good"))
    )
    # Written once, as every level reads it.
    hosts = checkpointed(
        parsed.groupBy("host").agg(F.count(F.lit(1)).alias("pages")).drop("pages")
        .join(outcomes, "host", "left")
        .select("host", *[F.coalesce(c, F.lit(0)).cast("double").alias(c) for c in ("n", "good")])
    )
    known = small_enough(checkpointed(reputation(hosts)))
    joined = parsed.join(known, "host", "left")
    rule = [longest_rule(F.col("host"), F.col("path"), rules, i) for i in (0, 1)]
    asked = F.greatest(F.lit(least_good), F.lit(least_share) * F.col("overall"))
    learned = F.when(F.col("bound") < asked, "block").otherwise("allow")
    return joined.select(
        "page_id", "host", "path", rule[1].alias("rule"),
        F.coalesce(rule[0], learned).alias("verdict"), "mean", "bound",
    )

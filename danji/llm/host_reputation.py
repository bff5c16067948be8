"""URL filter: listed rules first, then an empirical-Bayes reputation of the host."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from danji.llm.common import ascii_lower, cut


#: Public suffixes of more than one label, unless others are given; any other suffix is the last label.
SUFFIXES = (
    "ac.uk co.uk gov.uk ltd.uk me.uk net.uk org.uk plc.uk sch.uk com.au net.au org.au edu.au gov.au co.nz org.nz net.nz "
    "co.jp ac.jp or.jp ne.jp go.jp co.kr or.kr go.kr ac.kr com.br org.br net.br gov.br com.cn net.cn org.cn gov.cn edu.cn "
    "com.tw org.tw com.hk com.sg com.my co.in net.in org.in gov.in co.za org.za com.mx com.ar com.tr com.ua co.il com.sa"
).split()


@dataclass(frozen=True)
class Rule:
    """`text` is a host, then the beginning of a path from its slash on."""

    verdict: str
    text: str

    @property
    def host(self) -> str:
        return self.text.partition("/")[0]

    @property
    def path(self) -> str:
        return "/" + self.text.partition("/")[2]


def with_host_and_path(pages: DataFrame, url_col: str = "url") -> DataFrame:
    """Adds host and path: host from the first :// up to / ? # or the end, A-Z in lower case."""
    url = F.col(url_col)
    rest = F.expr(f"substring(`{url_col}`, locate('://', `{url_col}`) + 3)")
    there = F.coalesce(F.locate("://", url) > 0, F.lit(False))
    found = F.when(there, rest).otherwise("")
    host = F.regexp_extract(found, r"^[^/?#]*", 0)
    return pages.withColumns({
        "host": ascii_lower(host),
        "path": F.regexp_extract(found, r"^[^/?#]*([^?#]*)", 1),
    })


def with_levels(hosts: DataFrame, suffixes: list[str]) -> DataFrame:
    """Adds site, domain and suffix, the levels above a host.

    The site is the host without user and port and without dots at its end. The suffix is its last
    two labels if they are listed, else the last; the domain has one label more. A numeric address is
    its own domain and suffix.
    """
    site = F.rtrim(F.regexp_extract("host", r"^(?:.*@)?(\[[^\]]*\]|[^:]*)", 1), F.lit("."))
    last = [F.regexp_extract("site", rf"([^.]*\.){{0,{n}}}[^.]*$", 0) for n in range(3)]
    address = F.col("site").rlike(r"^([0-9]+(\.[0-9]+)*|\[.*)$")
    listed = last[1].isin(*suffixes) if suffixes else F.lit(False)
    return hosts.withColumn("site", site).withColumns({
        "domain": F.when(address, F.col("site")).when(listed, last[2]).otherwise(last[1]),
        "suffix": F.when(address, F.col("site")).when(listed, last[1]).otherwise(last[0]),
    })


def rule_of(rules: list[Rule]) -> Column:
    """The text of the longest rule that fits host and path, else null."""
    out = F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: (len(r.text), r.text)):
        fits = ((F.col("host") == rule.host) | F.col("host").endswith("." + rule.host)) & F.col("path").startswith(rule.path)
        out = F.when(fits, F.lit(rule.text)).otherwise(out)
    return out


def _concentration(units: DataFrame) -> Column:
    """kappa of the beta prior whose units (n, k) these are, by the method of moments."""
    named = units.where("n > 0").agg(
        F.count("*").alias("m"), F.sum("n").alias("s"), F.sum("k").alias("b"),
        F.sum(F.col("n") * F.col("n")).alias("nn"), F.sum(F.expr("double(k) * k / n")).alias("kkn"),
    ).selectExpr("m", "s", "b", "nn", "kkn", "double(b) / s as p")
    # sum of n (k/n - p)^2, by its expectation p q ((m - 1) + rho (s - nn/s - (m - 1)))
    rho = "((kkn - b * p) / (p * (1 - p)) - (m - 1)) / (s - double(nn) / s - (m - 1))"
    clipped = f"case when m > 1 and p > 0 and p < 1 and s - double(nn) / s - (m - 1) > 0 then least(greatest({rho}, 0.001d), 0.999d) else 0.5d end"
    return named.select(F.expr(f"1 / ({clipped}) - 1")).scalar()


def host_reputation(hosts: DataFrame, z: float, suffixes: list[str] = SUFFIXES) -> DataFrame:
    """The lower bound of each host's rate of bad pages: host, bad_low.

    hosts: host, bad (1, 0 or null where a page has no label), one row per page. The counts of a
    host's site (see with_levels) shrink toward its registered domain, that toward its public suffix,
    that toward all pages. How strongly is estimated at each level from all its units. The bound is
    the posterior mean less z posterior deviations.
    """
    # A row per host; kept, since every level and its prior are made of it.
    counted = cut(with_levels(
        hosts.groupBy("host").agg(F.count("bad").alias("n"), F.coalesce(F.sum("bad"), F.lit(0)).alias("k")), suffixes
    ))
    sums = [F.sum("n").alias("n"), F.sum("k").alias("k")]
    sites = counted.groupBy("site", "domain", "suffix").agg(*sums)
    domains = sites.groupBy("domain", "suffix").agg(*sums)
    tops = domains.groupBy("suffix").agg(*sums)
    root = tops.agg(*sums).selectExpr("(k + 1d) / (n + 2d) as rate").scalar()

    def shrunk(df: DataFrame, parent: Column, level: DataFrame) -> DataFrame:
        return df.withColumn("kappa", _concentration(level)).withColumn("parent", parent)

    by_suffix = shrunk(tops, F.coalesce(root, F.lit(0.5)), tops).selectExpr("suffix", "(k + kappa * parent) / (n + kappa) as suffix_rate")
    by_domain = shrunk(domains.join(by_suffix, "suffix"), F.col("suffix_rate"), domains).selectExpr(
        "domain", "(k + kappa * parent) / (n + kappa) as domain_rate"
    )
    bounds = shrunk(sites.join(by_domain, "domain"), F.col("domain_rate"), sites).selectExpr(
        "site", "k + kappa * parent as alpha", "n - k + kappa * (1 - parent) as beta"
    ).selectExpr(
        "site", f"alpha / (alpha + beta) - {z!r}d * sqrt(alpha * beta / ((alpha + beta) * (alpha + beta) * (alpha + beta + 1))) as bad_low"
    )
    return counted.select("host", "site").join(bounds, "site").select("host", "bad_low")


def judge_urls(
    pages: DataFrame, outcomes: DataFrame, rules: list[Rule], most_bad: float, z: float = 1.2815515655446004,
    id_col: str = "page_id", url_col: str = "url",
) -> DataFrame:
    """One row per row of pages: page_id, host, path, rule, verdict.

    outcomes: id and bad (0, 1 or null), repeats of an id count once, as bad if any is. A listed
    rule decides; else a page is blocked when the lower bound of its host's rate of bad pages is
    over most_bad. Labels are joined by id and reputations by host after the pages are counted per
    host; a host that holds a third of all pages is one row of the counts, and AQE splits the other
    side. A null url, or one without ://, has an empty host, and such pages share a reputation.
    Null ids have no label. Without rules every page is judged by reputation. An empty table gives no rows. Only id and url are read of pages.
    """
    parsed = with_host_and_path(pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("_url")), "_url").drop("_url")
    labels = outcomes.select(F.col(outcomes.columns[0]).alias("page_id"), F.col("bad").cast("bigint").alias("bad"))
    labels = labels.groupBy("page_id").agg(F.max("bad").alias("bad"))
    bound = host_reputation(parsed.join(labels, "page_id", "left").select("host", "bad"), z)
    listed = F.lit(None).cast("string")
    for r in rules:
        listed = F.when(F.col("rule") == r.text, r.verdict).otherwise(listed)
    judged = parsed.withColumn("rule", rule_of(rules)).join(bound, "host", "left")
    return judged.select(
        "page_id", "host", "path", "rule",
        F.when(F.col("rule").isNotNull(), listed)
        .when(F.col("bad_low") > most_bad, "block").otherwise("allow").alias("verdict"),
    )

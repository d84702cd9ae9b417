"""URL filters by empirical-Bayes host reputation (operator 3).

Labelled pages count, per host, how many turned out bad.  Rates are shrunk
from the top: the suffix (the longest of a list that ends the host, else its last
label) towards the overall rate, the registered domain (one label more) towards
its suffix, the host towards its domain, each
through a beta-binomial prior whose strength is estimated from the spread of
the children around their parents.  A page whose host's posterior lower bound
of the bad rate lies above ``max_bad`` is blocked.  Explicit rules come first.

User and port are no part of a host's domain and suffix.  An IP address is its own
domain and suffix, and so is a bare suffix.  The list of suffixes is a parameter
of at most ``MAX_SUFFIXES`` entries.

Defined results: a null url or one without ``://`` has an empty host and path,
no rule, and is judged by the empty host's own posterior; a host without
labelled pages takes its domain's posterior, and so on; without any labels the
prior of the top, one bad in ``prior_total`` pages, decides; labels repeated
for a page count once, the lowest quality; repeated pages count as pages; very long
urls are read whole; extra columns are left out.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

RULES = [("allow", "com/"), ("block", "example.com/en/"), ("allow", "www.example.com/en/"),
         ("block", "net/es/"), ("block", "net/fr/")]
MAX_RULES = 10_000
# Public suffixes of two labels, by country.
SUFFIXES = ("com.ar", "org.ar", "com.au", "net.au", "org.au", "edu.au", "gov.au",
            "com.br", "net.br", "org.br", "gov.br", "com.cn", "net.cn", "org.cn", "gov.cn",
            "com.co", "com.hk", "co.id", "or.id", "co.il", "org.il", "co.in", "net.in", "org.in",
            "co.jp", "ne.jp", "or.jp", "ac.jp", "go.jp", "co.ke", "co.kr", "or.kr", "com.mx",
            "org.mx", "gob.mx", "com.my", "com.ng", "co.nz", "net.nz", "org.nz", "com.pe",
            "com.ph", "com.pk", "com.pl", "net.pl", "org.pl", "com.sa", "com.sg", "co.th",
            "or.th", "com.tr", "org.tr", "com.tw", "org.tw", "com.ua", "co.uk", "org.uk",
            "ac.uk", "gov.uk", "com.ve", "com.vn", "co.za", "org.za")
MAX_SUFFIXES = 10_000


def url_host(url: Column) -> Column:
    rest = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    return F.coalesce(F.translate(rest, "ABCDEFGHIJKLMNOPQRSTUVWXYZ",
                                  "abcdefghijklmnopqrstuvwxyz"), F.lit(""))


def url_path(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def matching_rule(host: Column, path: Column, rules: Sequence[tuple[str, str]]
                  ) -> tuple[Column, Column]:
    """(rule, verdict) of the longest rule that fits, else nulls.  The rules
    are a parameter of proven size."""
    if len(rules) > MAX_RULES:
        raise ValueError(f"more than {MAX_RULES} rules: join them as a table instead")
    rule = verdict = F.lit(None).cast("string")
    for action, text in sorted(rules, key=lambda r: (len(r[1]), r[1])):
        at = text.index("/")
        own, start = text[:at].lower(), text[at:]
        fits = ((host == own) | F.endswith(host, F.lit("." + own))) & F.startswith(path, F.lit(start))
        rule = F.when(fits, F.lit(text)).otherwise(rule)
        verdict = F.when(fits, F.lit(action)).otherwise(verdict)
    return rule, verdict


def _listed(suffixes: Sequence[str]) -> str:
    """A pattern of a listed suffix or one label."""
    if len(suffixes) > MAX_SUFFIXES:
        raise ValueError(f"more than {MAX_SUFFIXES} suffixes: join them as a table instead")
    return "|".join([*(re.escape(x.lower()) for x in suffixes), "[^.]*"])


def host_name(host: Column) -> Column:
    """The host without user and port."""
    return F.regexp_replace(F.regexp_replace(host, r"(?s)^.*@", ""), r":[0-9]*\z", "")


def is_address(name: Column) -> Column:
    return name.rlike(r"^[0-9]+(\.[0-9]+){3}\z|^\[")


def domain_of(host: Column, suffixes: Sequence[str] = SUFFIXES) -> Column:
    """The suffix and one label before it; a bare suffix or an address is its own."""
    name = host_name(host)
    found = F.regexp_extract(name, rf"(?:^|\.)([^.]*\.(?:{_listed(suffixes)}))\z", 1)
    own = is_address(name) | (name == suffix_of(host, suffixes)) | (found == "")
    return F.when(own, name).otherwise(found)


def suffix_of(host: Column, suffixes: Sequence[str] = SUFFIXES) -> Column:
    """The leftmost place from which a listed suffix, or the last label, ends the host."""
    name = host_name(host)
    found = F.regexp_extract(name, rf"(?:^|\.)({_listed(suffixes)})\z", 1)
    return F.when(is_address(name), name).otherwise(found)


def _strength(children: DataFrame) -> Column:
    """Prior strength by moments: with rate ``p`` of the parent, a child of n
    pages has an expected squared deviation of 1 + (n - 1) * rho, in units of
    p (1 - p) / n; the strength is (1 - rho) / rho."""
    dev = (F.col("n") * F.pow(F.col("bad") / F.col("n") - F.col("p"), 2)
           / (F.col("p") * (1 - F.col("p"))))
    rho = (F.sum(dev) - F.count(F.lit(1))) / F.nullif(F.sum(F.col("n") - 1), F.lit(0))
    rho = F.least(F.greatest(F.coalesce(rho, F.lit(0.05)), F.lit(0.001)), F.lit(0.5))
    return ((1 - rho) / rho).alias("strength")


def _shrink(children: DataFrame, parents: DataFrame, key: str, parent: str) -> DataFrame:
    """Posterior rate of every child, given its parent's as the prior mean."""
    c = children.join(parents.select(F.col(parent).alias("_p"), F.col("rate").alias("p")),
                      children[parent] == F.col("_p")).drop("_p")
    prior = c.filter("n > 0").agg(_strength(c))
    return c.crossJoin(prior).select(
        key, *([parent] if parent != key else []), "n", "bad",
        (F.col("bad") + F.col("strength") * F.col("p")).alias("alpha"),
        (F.col("n") + F.col("strength")).alias("total"),
        ((F.col("bad") + F.col("strength") * F.col("p"))
         / (F.col("n") + F.col("strength"))).alias("rate"))


def host_reputation(outcomes: DataFrame, prior_bad: float = 1.0, prior_total: float = 10.0,
                    z: float = 1.645, suffixes: Sequence[str] = SUFFIXES) -> DataFrame:
    """One row per host of ``outcomes`` (host, bad: 1, 0 or null): posterior
    rate and lower bound."""
    host = (outcomes.groupBy("host")
            .agg(F.count("bad").alias("n"), F.coalesce(F.sum("bad"), F.lit(0)).alias("bad"))
            .withColumn("domain", domain_of(F.col("host"), suffixes))
            .withColumn("suffix", suffix_of(F.col("host"), suffixes)))
    domain = host.groupBy("domain", "suffix").agg(F.sum("n").alias("n"), F.sum("bad").alias("bad"))
    suffix = domain.groupBy("suffix").agg(F.sum("n").alias("n"), F.sum("bad").alias("bad"))
    top = suffix.agg(((F.sum("bad") + prior_bad) / (F.sum("n") + prior_total)).alias("rate"))
    top = suffix.select("suffix").crossJoin(top)
    s = _shrink(suffix, top, "suffix", "suffix")
    d = _shrink(domain, s, "domain", "suffix")
    h = _shrink(host.drop("suffix"), d, "host", "domain")
    spread = F.sqrt(F.col("rate") * (1 - F.col("rate")) / (F.col("total") + 1))
    return h.select("host", "n", "bad", "rate",
                    F.greatest(F.col("rate") - z * spread, F.lit(0.0)).alias("lower_bound"))


def judge_urls(pages: DataFrame, labels: DataFrame, rules: Sequence[tuple[str, str]] = RULES,
               page_col: str = "page_id", url_col: str = "url", label_id: str = "doc_id",
               max_bad: float = 0.15, **prior) -> DataFrame:
    """One row per page: id, host, path, rule, verdict, rate and lower bound.

    Pages are counted by host before anything is shuffled, and the reputation
    of the hosts goes back to the pages in a join that AQE broadcasts when its
    measured size allows, and splits at a hot host otherwise."""
    host, path = url_host(F.col(url_col)), url_path(F.col(url_col))
    page = pages.select(F.col(page_col), host.alias("host"), path.alias("path"))
    known = (labels.filter(F.col(label_id).isNotNull()).groupBy(F.col(label_id).alias("_id"))
             .agg((1 - F.min("quality")).cast("long").alias("bad")))
    seen = page.select(F.col(page_col).alias("_page"), "host")
    rep = host_reputation(seen.join(known, F.col("_page") == F.col("_id"), "left"), **prior)
    rule, verdict = matching_rule(F.col("host"), F.col("path"), rules)
    rep = rep.select(F.col("host").alias("_host"), "rate", "lower_bound")
    own = F.when(F.col("lower_bound") > max_bad, "block").otherwise("allow")
    return (page.join(rep, page["host"] == rep["_host"])
            .select(page_col, "host", "path", rule.alias("rule"),
                    F.coalesce(verdict, own).alias("verdict"), "rate", "lower_bound"))


def op3_host_reputation(spark, sf_dir: str) -> DataFrame:
    return judge_urls(spark.read.parquet(f"{sf_dir}/pages.parquet"),
                      spark.read.parquet(f"{sf_dir}/labels.parquet")
                      ).select("page_id", "host", "path", "rule", "verdict")


OP3_SQL = r"""
WITH p AS (
  SELECT page_id,
         coalesce(translate(regexp_extract(url, '^.*?://([^/?#]*)', 1, 's'),
                            'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') AS host,
         coalesce(regexp_extract(url, '^.*?://[^/?#]*([^?#]*)', 1, 's'), '') AS path
  FROM pages),
k AS (SELECT doc_id, 1 - min(quality) AS bad FROM labels WHERE doc_id IS NOT NULL GROUP BY doc_id),
h0a AS (
  SELECT host, count(bad) AS n, coalesce(sum(bad), 0)::BIGINT AS bad,
         regexp_replace(regexp_replace(host, '^.*@', '', 's'), ':[0-9]*\z', '') AS name
  FROM p LEFT JOIN k ON page_id = doc_id GROUP BY host),
g AS (
  SELECT *, regexp_matches(name, '^[0-9]+(\.[0-9]+){3}\z|^\[') AS address,
         string_split(name, '.')[-1] AS last, string_split(name, '.')[-2] AS second,
         string_split(name, '.')[-3] AS third FROM h0a),
h AS (
  SELECT host, n, bad,
         CASE WHEN address THEN name WHEN second || '.' || last IN (SUFFIXES) THEN
              coalesce(third || '.', '') || second || '.' || last
              ELSE coalesce(second || '.', '') || last END AS domain,
         CASE WHEN address THEN name WHEN second || '.' || last IN (SUFFIXES)
              THEN second || '.' || last ELSE last END AS suffix FROM g),
d AS (SELECT domain, suffix, sum(n)::BIGINT AS n, sum(bad)::BIGINT AS bad FROM h GROUP BY ALL),
s AS (SELECT suffix, sum(n)::BIGINT AS n, sum(bad)::BIGINT AS bad FROM d GROUP BY ALL),
t AS (SELECT (sum(bad) + 1.0::DOUBLE) / (sum(n) + 10.0::DOUBLE) AS p FROM s),
s0 AS (SELECT suffix, n, bad, p FROM s, t),
sr AS (SELECT least(greatest(coalesce((sum(n * pow(bad / n - p, 2) / (p * (1 - p))) - count(*))
       / nullif(sum(n - 1), 0), 0.05), 0.001), 0.5)::DOUBLE AS rho FROM s0 WHERE n > 0),
s1 AS (SELECT suffix, (bad + (1 - rho) / rho * p) / (n + (1 - rho) / rho) AS rate FROM s0, sr),
d0 AS (SELECT d.*, rate AS p FROM d JOIN s1 USING (suffix)),
dr AS (SELECT least(greatest(coalesce((sum(n * pow(bad / n - p, 2) / (p * (1 - p))) - count(*))
       / nullif(sum(n - 1), 0), 0.05), 0.001), 0.5)::DOUBLE AS rho FROM d0 WHERE n > 0),
d1 AS (SELECT domain, (bad + (1 - rho) / rho * p) / (n + (1 - rho) / rho) AS rate FROM d0, dr),
h0 AS (SELECT h.*, rate AS p FROM h JOIN d1 USING (domain)),
hr AS (SELECT least(greatest(coalesce((sum(n * pow(bad / n - p, 2) / (p * (1 - p))) - count(*))
       / nullif(sum(n - 1), 0), 0.05), 0.001), 0.5)::DOUBLE AS rho FROM h0 WHERE n > 0),
h1 AS (SELECT host, (bad + (1 - rho) / rho * p) / (n + (1 - rho) / rho) AS rate,
              n + (1 - rho) / rho AS total FROM h0, hr),
r AS (SELECT *, CASE
        WHEN (host = 'www.example.com' OR ends_with(host, '.www.example.com'))
             AND starts_with(path, '/en/') THEN 'www.example.com/en/'
        WHEN (host = 'example.com' OR ends_with(host, '.example.com'))
             AND starts_with(path, '/en/') THEN 'example.com/en/'
        WHEN (host = 'net' OR ends_with(host, '.net')) AND starts_with(path, '/es/') THEN 'net/es/'
        WHEN (host = 'net' OR ends_with(host, '.net')) AND starts_with(path, '/fr/') THEN 'net/fr/'
        WHEN (host = 'com' OR ends_with(host, '.com')) AND starts_with(path, '/') THEN 'com/' END
      AS rule FROM p)
SELECT page_id, host, path, rule,
       CASE WHEN rule IN ('com/', 'www.example.com/en/') THEN 'allow'
            WHEN rule IS NOT NULL THEN 'block'
            WHEN greatest(rate - 1.645::DOUBLE * sqrt(rate * (1 - rate) / (total + 1)), 0)
                 > 0.15 THEN 'block' ELSE 'allow' END AS verdict
FROM r JOIN h1 USING (host)
""".replace("SUFFIXES", ", ".join(f"'{x}'" for x in SUFFIXES))

"""URL filters: explicit host and path rules, else empirical-Bayes host reputation.

Labelled pages vote on their host.  A host's share of good pages is shrunk by a
beta prior centred on its registered domain's, that on its suffix's, and that on
the share over all pages.  Each level's prior strength comes from the spread of
its groups around their parents (beta-binomial method of moments).  A host is
blocked when even the upper bound of its posterior (mean plus ``z`` deviations)
stays below ``min_good``.

Defined results: a null url, or one without ``://``, has an empty host and path
and is judged as the host ''.  Pages without a label count for no host; several
labels for a page are as many outcomes; null outcomes are ignored; without any
outcome no host is blocked.  A port is no part of a domain, and a host of four numbers
is a domain of its own, under the suffix ''.  Repeated rows
and ids come back as often as they came; urls of any length are judged whole; other
columns are ignored, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ._store import Workspace

#: (rule, verdict); a rule is a host followed by a path
RULES = (
    ("com/", "allow"),
    ("example.com/en/", "block"),
    ("www.example.com/en/", "allow"),
    ("net/es/", "block"),
    ("net/fr/", "block"),
)
#: public suffixes of two labels where no list is given; all others have one
TWO_LABEL_SUFFIXES = ("co.uk", "org.uk", "com.au", "co.jp", "com.br")
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def url_host(url: Column) -> Column:
    return F.translate(F.regexp_extract(F.coalesce(url, F.lit("")), r"://([^/?#]*)", 1), _UPPER, _LOWER)


def url_path(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"://[^/?#]*([^?#]*)", 1)


def rule_for(host: Column, path: Column, rules=RULES) -> Column:
    """The longest rule that fits, else null."""
    out = F.lit(None).cast("string")
    for rule, _ in sorted(rules, key=lambda r: (len(r[0]), r[0])):
        h, slash, p = rule.partition("/")
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(slash + p)
        out = F.when(fits, F.lit(rule)).otherwise(out)
    return out


_PORT, _NUMBERS = ":[0-9]*$", r"^[0-9]+([.][0-9]+){3}$"


def suffix_of(host: Column, two_label=TWO_LABEL_SUFFIXES) -> Column:
    bare = F.regexp_replace(host, _PORT, "")
    last_two = F.substring_index(bare, ".", -2)
    return F.when(bare.rlike(_NUMBERS), F.lit("")).when(last_two.isin(*two_label), last_two).otherwise(F.substring_index(bare, ".", -1))


def domain_of(host: Column, two_label=TWO_LABEL_SUFFIXES) -> Column:
    bare = F.regexp_replace(host, _PORT, "")
    last_two = F.substring_index(bare, ".", -2)
    return F.when(bare.rlike(_NUMBERS), bare).when(last_two.isin(*two_label), F.substring_index(bare, ".", -3)).otherwise(last_two)


def _strength(groups: DataFrame, parent_mean: str) -> DataFrame:
    """One row: correlation within a level's groups, from their spread around the parents' means."""
    m = F.sum("good") / F.sum("n")
    v = m * (1 - m)
    k = F.count("*") - 1
    room = F.sum("n") - F.sum(F.col("n") * F.col("n")) / F.sum("n") - k
    spread = F.sum(F.col("n") * F.pow(F.col("good") / F.col("n") - F.col(parent_mean), F.lit(2)))
    rho = F.when((v > 0) & (room > 0), (spread / v - k) / room).otherwise(F.lit(0.0))
    rho = F.least(F.greatest(F.coalesce(rho, F.lit(0.0)), F.lit(0.001)), F.lit(0.9))
    return groups.filter("n > 0").agg(rho.alias("rho"))


def _shrunk(groups: DataFrame, parent_mean: str, out: str) -> DataFrame:
    """Add the posterior mean and strength of each group."""
    rho = _strength(groups, parent_mean).first()[0]
    kappa = F.lit(1 / rho - 1)
    total = kappa + F.col("n")
    return groups.withColumn(out, (kappa * F.col(parent_mean) + F.col("good")) / total).withColumn("strength", total)


def host_reputation(spark: SparkSession, pages: DataFrame, outcomes: DataFrame, ws: Workspace, two_label=TWO_LABEL_SUFFIXES) -> DataFrame:
    """Hosts with their posterior mean and deviation.

    ``pages`` has page_id and host; ``outcomes`` page_id and good (0 or 1).
    """
    seen = pages.join(outcomes.filter("good is not null").select("page_id", "good"), "page_id", "left")
    hosts = ws.put(seen.groupBy("host").agg(F.count("good").cast("double").alias("n"), F.coalesce(F.sum("good"), F.lit(0)).cast("double").alias("good")), "hosts")
    hosts = hosts.withColumn("domain", domain_of(F.col("host"), two_label)).withColumn("suffix", suffix_of(F.col("host"), two_label))
    counts = (F.sum("n").alias("n"), F.sum("good").alias("good"))
    domains = ws.put(hosts.groupBy("domain", "suffix").agg(*counts), "domains")
    suffixes = domains.groupBy("suffix").agg(*counts)
    whole = suffixes.agg(F.coalesce(F.sum("good"), F.lit(0.0)), F.coalesce(F.sum("n"), F.lit(0.0))).first()
    suffixes = suffixes.withColumn("mean0", F.lit((whole[0] + 1) / (whole[1] + 2) if whole[1] else 1.0))
    suffixes = ws.put(_shrunk(suffixes, "mean0", "mean1").select("suffix", "mean1"), "suffixes")
    domains = ws.put(_shrunk(domains.join(suffixes, "suffix"), "mean1", "mean2").select("domain", "mean2"), "domain_means")
    hosts = _shrunk(hosts.join(domains, "domain"), "mean2", "mean")
    return ws.put(hosts.select("host", "n", "mean", F.sqrt(F.col("mean") * (1 - F.col("mean")) / (F.col("strength") + 1)).alias("deviation")), "reputation")


def filter_urls(spark: SparkSession, pages: DataFrame, outcomes: DataFrame, rules=RULES, min_good: float = 0.8, z: float = 1.0, two_label=TWO_LABEL_SUFFIXES) -> DataFrame:
    """page_id, host, path, rule and verdict, with the host's posterior; ``two_label`` lists suffixes of two labels."""
    ws = Workspace(spark, "url-filter")
    host, path = url_host(F.col("url")), url_path(F.col("url"))
    urls = pages.select(F.col("page_id"), host.alias("host"), path.alias("path"))
    reputation = host_reputation(spark, urls.select("page_id", "host"), outcomes, ws, two_label)
    judged = urls.withColumn("rule", rule_for(F.col("host"), F.col("path"), rules)).join(reputation, "host", "left")
    by_rule = F.lit(None).cast("string")
    for rule, verdict in rules:
        by_rule = F.when(F.col("rule") == rule, F.lit(verdict)).otherwise(by_rule)
    upper = F.col("mean") + z * F.col("deviation")
    verdict = F.coalesce(by_rule, F.when(upper < min_good, F.lit("block")).otherwise(F.lit("allow")))
    return judged.select("page_id", "host", "path", "rule", verdict.alias("verdict"), "n", "mean", "deviation")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contract rows over all pages; a page's outcome is the quality label of its number."""
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    outcomes = labels.select(F.col("doc_id").alias("page_id"), F.col("quality").alias("good"))
    return filter_urls(spark, pages, outcomes).select("page_id", "host", "path", "rule", "verdict")


def _sql_level(name: str, source: str, key: str, parent: str, mean: str, extra: str = "") -> str:
    return f"""
{name}_k AS (
  SELECT CASE WHEN v > 0 AND room > 0 THEN (spread / v - k) / room ELSE 0 END AS rho FROM (
    SELECT m * (1 - m) AS v, k, spread, room FROM (
      SELECT sum(good) / sum(n) AS m, count(*) - 1 AS k, sum(n * pow(good / n - {parent}, 2)) AS spread,
             sum(n) - sum(n * n) / sum(n) - (count(*) - 1) AS room FROM {source} WHERE n > 0))),
{name} AS (
  SELECT {key}, n, good{extra}, (kappa * {parent} + good) / (kappa + n) AS {mean}, kappa + n AS strength
  FROM {source}, (SELECT 1 / least(greatest(coalesce(rho, 0), 0.001), 0.9) - 1 AS kappa FROM {name}_k))"""


SQL = rf"""
WITH urls AS (
  SELECT page_id, translate(regexp_extract(coalesce(url, ''), '://([^/?#]*)', 1), '{_UPPER}', '{_LOWER}') AS host,
         regexp_extract(coalesce(url, ''), '://[^/?#]*([^?#]*)', 1) AS path FROM pages),
parts AS (
  SELECT *, string_split(regexp_replace(host, ':[0-9]*$', ''), '.') AS p, regexp_matches(regexp_replace(host, ':[0-9]*$', ''), '^[0-9]+([.][0-9]+){{3}}$') AS ip FROM urls),
named AS (
  SELECT page_id, host, path, ip, array_to_string(p[-2:], '.') IN ({", ".join(f"'{x}'" for x in TWO_LABEL_SUFFIXES)}) AS two, p FROM parts),
keyed AS (
  SELECT page_id, host, path, CASE WHEN ip THEN array_to_string(p, '.') WHEN two THEN array_to_string(p[-3:], '.') ELSE array_to_string(p[-2:], '.') END AS domain,
         CASE WHEN ip THEN '' WHEN two THEN array_to_string(p[-2:], '.') ELSE p[-1] END AS suffix FROM named),
h0 AS (
  SELECT host, domain, suffix, count(quality)::DOUBLE AS n, coalesce(sum(quality), 0)::DOUBLE AS good
  FROM keyed LEFT JOIN labels ON page_id = doc_id GROUP BY ALL),
d0 AS (SELECT domain, suffix, sum(n) AS n, sum(good) AS good FROM h0 GROUP BY ALL),
s00 AS (SELECT suffix, sum(n) AS n, sum(good) AS good FROM d0 GROUP BY ALL),
s0 AS (SELECT *, (SELECT CASE WHEN sum(n) > 0 THEN (sum(good) + 1) / (sum(n) + 2) ELSE 1 END FROM s00) AS mean0 FROM s00),
{_sql_level("s1", "s0", "suffix", "mean0", "mean1").strip()},
d00 AS (SELECT d0.*, mean1 FROM d0 JOIN s1 USING (suffix)),
{_sql_level("d1", "d00", "domain", "mean1", "mean2").strip()},
h00 AS (SELECT h0.*, mean2 FROM h0 JOIN d1 USING (domain)),
{_sql_level("h1", "h00", "host", "mean2", "mean").strip()},
ruled AS (
  SELECT page_id, host, path, CASE
    {" ".join(f"WHEN (host = '{r.partition('/')[0]}' OR ends_with(host, '.{r.partition('/')[0]}')) AND starts_with(path, '/{r.partition('/')[2]}') THEN '{r}'" for r, _ in sorted(RULES, key=lambda r: (-len(r[0]), r[0])))}
    END AS rule FROM urls)
SELECT page_id, host, path, rule, CASE
    {" ".join(f"WHEN rule = '{r}' THEN '{v}'" for r, v in RULES)}
    WHEN mean + 1.0 * sqrt(mean * (1 - mean) / (strength + 1)) < 0.8 THEN 'block' ELSE 'allow' END AS verdict
FROM ruled JOIN h1 USING (host)
"""

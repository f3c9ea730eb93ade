"""URL rules by hashed host-suffix and path-prefix expressions.

A rule is (host, path, verdict) and fits its host and all subdomains where the url's path starts
with the rule's. Each distinct host is expanded to its suffixes, which meet the rules' hosts in an equi-join on the
first 4 bytes of the SHA-256 digest; the full digests decide. Urls of hosts that hit are expanded to host suffix + path
prefix, prefixes ending after a '/', at the depths that the rules of that host have; each rule is filed under its host + path up to the last '/'.
Both sides meet in the same way, and a hit counts only if the full digests are equal
and the whole rule path starts the url's path. The longest rule wins; of equally long ones, the
longer host, then ``block``. No list of hosts or rules is collected, and the size of either side is
left to the join.

Host: after the first ``://`` up to '/', '?', '#' or the end, A-Z in lower case; path: from there up to
'?', '#' or the end. Defined results: null urls and urls without ``://`` have empty host and path; no
rule fits an empty host unless its own is empty; rules with null host or verdict are ignored, a null
path is empty; repeated urls are judged once and each row keeps its result. Other columns are kept;
host, path, rule and verdict replace columns of those names. A host of n labels costs n suffixes; a path costs one prefix for each
depth of the rules that its host meets, however long it is.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def split_url(url: Column) -> tuple[Column, Column]:
    """Host and path of a url."""
    at = F.locate("://", url)
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")
    rest = F.coalesce(rest, F.lit(""))
    host = F.translate(F.regexp_extract(rest, r"^[^/?#]*", 0), UPPER, LOWER)
    return host, F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def suffixes(host: Column) -> Column:
    """The host without its first 0, 1, ... labels."""
    return F.transform(F.sequence(F.lit(1), F.size(F.split(host, r"\."))), lambda n: F.call_function("substring_index", host, F.lit("."), -n))


def _digest(df: DataFrame, expression: Column, name: str) -> DataFrame:
    """``df`` with the digest of an expression, and ``short``, the part of it that is joined on."""
    return df.withColumn(name, F.unhex(F.sha2(expression, 256))).withColumn("short", F.substring(name, 1, 4))


def judge(df: DataFrame, rules: DataFrame, default: str = "allow", url: str = "url") -> DataFrame:
    """``df`` with host, path, rule (host + path, or null) and verdict."""
    names = [c for c in df.columns if c not in ("host", "path", "rule", "verdict")]
    host, path = split_url(F.col("__url"))
    urls = (df.select(F.col(url).cast("string").alias("__url")).filter("__url is not null").distinct()
            .withColumn("host", host).withColumn("path", path))
    rule_path = F.coalesce(F.col("path"), F.lit(""))
    filed = (rules.filter("host is not null and verdict is not null")
             .select(F.translate("host", UPPER, LOWER).alias("rule_host"), rule_path.alias("rule_path"), F.col("verdict").alias("found"))
             .distinct()
             .withColumn("front", F.regexp_extract("rule_path", r"^(?s)(.*/)?", 0)))
    depth = F.length("front") - F.length(F.replace("front", F.lit("/"), F.lit("")))
    places = _digest(filed.select("rule_host", depth.alias("depth")).distinct(), F.col("rule_host"), "rule_digest")
    hosts = _digest(urls.select("host").distinct().withColumn("suffix", F.explode(suffixes(F.col("host")))), F.col("suffix"), "digest")
    met = hosts.join(places, "short").filter(F.col("digest") == F.col("rule_digest")).select("host", "rule_host", "depth")
    front = F.when(F.col("depth") > 0, F.concat(F.expr("substring_index(path, '/', depth)"), F.lit("/"))).otherwise("")
    asked = urls.join(met, "host").withColumn("front", front).filter(F.col("path").startswith(F.col("front")))
    asked = (_digest(asked, F.concat("rule_host", F.lit("\n"), "front"), "digest")
             .select("__url", F.col("path").alias("whole"), "digest", "short"))
    filed = (_digest(filed, F.concat("rule_host", F.lit("\n"), "front"), "rule_digest")
             .select("rule_host", "rule_path", "found", "rule_digest", "short"))
    order = F.struct((F.length("rule_host") + F.length("rule_path")).alias("size"), F.length("rule_host").alias("of_host"),
                     (F.col("found") == "block").alias("blocks"), F.concat("rule_host", "rule_path").alias("rule"),
                     F.col("found").alias("verdict"))
    best = (asked.join(filed, "short").filter((F.col("digest") == F.col("rule_digest")) & F.col("whole").startswith(F.col("rule_path")))
            .groupBy("__url").agg(F.max(order).alias("best")))
    own_host, own_path = split_url(F.col(url).cast("string"))
    joined = df.select(*names, F.col(url).cast("string").alias("__url")).join(best, "__url", "left")
    return joined.select(*names, own_host.alias("host"), own_path.alias("path"), F.col("best.rule").alias("rule"),
                         F.coalesce("best.verdict", F.lit(default)).alias("verdict"))

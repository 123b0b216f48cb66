"""URL block and allow rules by host-suffix and path-prefix expressions.

Each distinct URL is expanded into the expressions under which a rule for it can be filed:
its host suffixes times its path prefixes that end in a slash.  Only as many labels and
slashes as the largest rule has are expanded, which loses nothing.  Expressions meet rules
by an equi-join on a short hash prefix; the full digest and the rest of the rule's path are
then confirmed, and the longest fitting rule wins.

Rules with equal host and path: block wins.  A URL that is null or has no ``://`` has an
empty host and path, fits no rule and is allowed.  Null and repeated page ids are carried
along.  Input columns other than the id and the URL are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cartlark.llm import common

#: Rules of the query: host and path, and what they say.
RULES = (("net/", "block"), ("example.net/en/", "allow"), ("example.com/de/", "block"),
         ("org/fr/", "allow"))
DEFAULT = "allow"
#: Rule tables up to this many bytes are sent to every executor.
BROADCAST_BYTES = 64 << 20
_SHORT_BITS = 32
_AZ, _SMALL = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def split_url(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path of a URL; empty where it has no ``://``."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substr(url, at + 3)).otherwise("")
    rest = F.regexp_extract(F.coalesce(rest, F.lit("")), "(?s)^[^?#]*", 0)
    host = F.regexp_extract(rest, "^[^/]*", 0)
    return F.translate(host, _AZ, _SMALL), F.regexp_extract(rest, "(?s)/.*", 0)


def parse_rules(spark: SparkSession, rules) -> DataFrame:
    """``host``, ``path``, ``verdict`` rows from ``(host/path, verdict)`` pairs."""
    rows = []
    for rule, verdict in rules:
        host, slash, path = rule.partition("/")
        rows.append((host.lower(), slash + path, verdict))
    return spark.createDataFrame(rows, "host string, path string, verdict string")


def _full(host: Column, folder: Column) -> Column:
    return F.sha2(F.concat(host, F.lit("\0"), folder), 256)


def _short(digest: Column) -> Column:
    return F.conv(F.substring(digest, 1, _SHORT_BITS // 4), 16, 10).cast("bigint")


def filed_rules(rules: DataFrame) -> DataFrame:
    """One row per rule with the expression it is filed under: its host and its path up to
    the last slash."""
    folder = F.regexp_extract("path", "(?s)^.*/", 0)
    return (
        rules.filter("host is not null and path is not null")
        .groupBy("host", "path")
        .agg(F.min_by("verdict", F.when(F.col("verdict") == "block", 0).otherwise(1))
             .alias("verdict"))
        .withColumn("digest", _full(F.col("host"), folder))
        .withColumn("short", _short(F.col("digest")))
    )


def judge(pages: DataFrame, rules: DataFrame, default: str = DEFAULT) -> DataFrame:
    """``page_id``, ``host``, ``path``, ``rule`` and ``verdict`` of ``page_id``, ``url`` rows."""
    filed = filed_rules(rules)
    labels, slashes, n, wide = filed.agg(
        F.coalesce(F.max(F.size(F.split("host", "\\."))), F.lit(0)),
        F.coalesce(F.max(F.size(F.split("path", "/")) - 1), F.lit(0)),
        F.count("*"),
        F.coalesce(F.max(F.octet_length("host") + F.octet_length("path")), F.lit(0)),
    ).first()
    if n * (wide + 200) <= BROADCAST_BYTES:
        filed = F.broadcast(filed)
    host, path = split_url(F.col("url"))
    rows = pages.select("page_id", host.alias("host"), path.alias("path"))
    # Combined before the shuffle: a hot URL is one row from here on.
    urls = rows.select("host", "path").distinct().filter("host != ''")
    expressions = (
        urls.withColumn("parts", F.split("host", "\\."))
        .withColumn("suffixes", F.expr(
            f"transform(sequence(1, least(size(parts), {labels})), "
            "n -> array_join(slice(parts, size(parts) - n + 1, n), '.'))"))
        .withColumn("folders", F.expr(
            f"transform(sequence(0, least(size(split(path, '/')) - 1, {slashes})), "
            "n -> if(n = 0, '', concat(substring_index(path, '/', n), '/')))"))
        .select("host", "path", "folders", F.explode("suffixes").alias("suffix"))
        .select("host", "path", "suffix", F.explode("folders").alias("folder"))
        .withColumn("digest", _full(F.col("suffix"), F.col("folder")))
        .withColumn("short", _short(F.col("digest")))
        .select("host", "path", "digest", "short")
    )
    known = filed.select(
        "short", F.col("digest").alias("rule_digest"), F.col("host").alias("rule_host"),
        F.col("path").alias("rule_path"), F.col("verdict").alias("rule_verdict"),
    )
    fits = (F.col("digest") == F.col("rule_digest")) & F.startswith("path", "rule_path")
    length = F.length("rule_host") + F.length("rule_path")
    best = (
        expressions.join(known, "short")
        .filter(fits)
        .groupBy("host", "path")
        .agg(F.max_by(
            F.struct(F.concat("rule_host", "rule_path").alias("rule"), "rule_verdict"),
            F.struct(length.alias("n"), F.length("rule_host").alias("h")),
        ).alias("won"))
    )
    return rows.join(best, ["host", "path"], "left").select(
        "page_id", "host", "path", F.col("won.rule").alias("rule"),
        F.coalesce("won.rule_verdict", F.lit(default)).alias("verdict"),
    )


def op7_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fixed rules over all pages."""
    return judge(common.table(spark, sf_dir, "pages"), parse_rules(spark, RULES))


OP7_SQL = """
with rules(host, path, verdict) as (
    values ('net', '/', 'block'), ('example.net', '/en/', 'allow'),
           ('example.com', '/de/', 'block'), ('org', '/fr/', 'allow')
), rested as (
    select page_id, regexp_extract(
        case when contains(url, '://') then substr(url, instr(url, '://') + 3) else '' end,
        '^[^?#]*') rest
    from pages
), parts as (
    select page_id, translate(regexp_extract(coalesce(rest, ''), '^[^/]*'),
                              'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') host,
           regexp_extract(coalesce(rest, ''), '/.*', 0, 's') path
    from rested
), urls as (
    select distinct host, path from parts
), fitting as (
    select u.host, u.path, arg_max(r.host || r.path, length(r.host || r.path)) rule,
           arg_max(r.verdict, length(r.host || r.path)) verdict
    from urls u join rules r
      on (u.host = r.host or ends_with(u.host, '.' || r.host)) and starts_with(u.path, r.path)
    group by all
)
select page_id, p.host, p.path, f.rule, coalesce(f.verdict, 'allow') verdict
from parts p left join fitting f on p.host = f.host and p.path = f.path
"""

"""URL filter by hashed host-suffix and path-prefix expressions, Catalyst only.

Every URL expands into expressions: each suffix of its host with no more labels than
the longest rule's host has, joined with each prefix of its path that has the length
of some rule's path. A URL's work thus follows the rules, not the length of its host. Expressions and
rules meet in an equi-join on the first bytes of their digests; the full digests
then confirm the match, and the longest rule decides.

A null URL, and one without "://", has empty host and path. Then, and wherever no
rule fits, the rule is null and the verdict is the default.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: The contract's rules: (host, path, verdict).
RULES: tuple[tuple[str, str, str], ...] = (
    ("org", "/", "allow"),
    ("example.org", "/es/", "block"),
    ("example.org", "/en/1", "block"),
    ("com", "/fr/", "allow"),
    ("com", "/de/", "block"),
)
PREFIX_DIGITS = 8  # hex digits of the digest that the join uses
# Rules up to this many rows are broadcast (about 200 bytes each); beyond, both sides shuffle.
BROADCAST_RULES = 100_000


def _lower(text: Column) -> Column:
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def host_of(url: Column) -> Column:
    return F.coalesce(_lower(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_table(spark: SparkSession, rules: Sequence[tuple[str, str, str]] = RULES) -> DataFrame:
    """Rules as rows: host, path, verdict."""
    return spark.createDataFrame(list(rules), "host string, path string, verdict string")


def judge(urls: DataFrame, rules: DataFrame, id_col: str = "page_id", url_col: str = "url",
          default: str = "allow") -> DataFrame:
    """One row per row of ``urls``: id_col, url_col, host, path, rule, verdict.

    ``rules`` has host, path and verdict (allow or block); of rules for the same host and
    path a blocking one wins, rules with a null are ignored. Other columns aren't read.
    """
    own = (rules.select(_lower(F.col("host")).alias("h"), F.col("path").alias("p"), (F.col("verdict") == "block").alias("b"))
           .dropna().groupBy("h", "p").agg(F.max("b").alias("block")).withColumn("digest", _digest("h", "p")))
    # Rules that share the short hash stand together, so that an expression meets one row at most.
    table = own.groupBy(F.substring("digest", 1, PREFIX_DIGITS).alias("short")).agg(
        F.collect_list(F.struct("digest", "block")).alias("rules"))
    # Lengths of rule paths, as many numbers as there are lengths, and labels of the longest rule host.
    shape = own.agg(F.sort_array(F.collect_set(F.length("p"))), F.max(F.size(F.split("h", r"\.", -1)))).first()
    lengths, most = shape[0], shape[1] or 1
    few = len(own.select("block").take(BROADCAST_RULES + 1)) <= BROADCAST_RULES

    rows = urls.select(F.col(id_col).alias("id"), F.col(url_col).alias("url"), host_of(F.col(url_col)).alias("host"),
                       path_of(F.col(url_col)).alias("path"))
    labels = F.split("host", r"\.", -1)
    first = F.greatest(F.lit(1), F.size(labels) - most + 1)
    usable = F.filter(F.array(*map(F.lit, lengths)).cast("array<int>"), lambda n: n <= F.length("path"))

    def suffix(k: Column) -> Column:
        return F.array_join(F.slice(labels, k, F.size(labels)), ".")

    def prefix(n: Column) -> Column:
        return F.substring(F.col("path"), F.lit(1), n)

    digests = F.flatten(F.transform(F.sequence(first, F.size(labels)), lambda k: F.transform(
        usable, lambda n: F.struct(_digest(suffix(k), prefix(n)).alias("digest"),
                                   (F.length(suffix(k)) + n).alias("length")))))
    looked = rows.select("*", F.posexplode_outer(F.when(F.col("host") != "", digests)).alias("place", "e")).withColumn(
        "short", F.substring("e.digest", 1, PREFIX_DIGITS))
    joined = looked.join(F.broadcast(table) if few else table, "short", "left")
    confirmed = F.filter("rules", lambda r: r["digest"] == F.col("e.digest"))
    # The longest rule wins: its length, verdict and place in one number, so that the
    # aggregation hashes. All expressions of a row stand together and become one row before
    # anything is shuffled; equal rows share a group and are counted.
    code = (F.shiftleft(F.col("e.length").cast("long"), 32) + F.when(F.get(confirmed, 0)["block"], 1 << 31).otherwise(0)
            + F.col("place").cast("long"))
    judged = joined.groupBy("id", "url", "host", "path").agg(
        F.max(F.when(F.size(confirmed) > 0, code)).alias("best"),
        F.sum((F.coalesce("place", F.lit(0)) == 0).cast("long")).alias("copies"))
    place = F.col("best") % (1 << 31)
    per = F.size(usable)
    rule = F.when(F.col("best").isNotNull(), F.concat(
        suffix((F.floor(place / per) + first).cast("int")), prefix(F.get(usable, (place % per).cast("int")))))
    block = F.floor(F.col("best") / (1 << 31)) % 2 == 1
    out = judged.select("*", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))).alias("copy"))
    return out.select(
        F.col("id").alias(id_col), F.col("url").alias(url_col), "host", "path", rule.alias("rule"),
        F.when(F.col("best").isNull(), F.lit(default)).when(block, "block").otherwise("allow").alias("verdict"))


def _digest(host: Column | str, path: Column | str) -> Column:
    return F.sha2(F.concat(host, F.lit("\n"), path), 256)

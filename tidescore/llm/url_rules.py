"""URL allow and block rules by host suffix and path prefix, in DataFrame functions only.

A URL is expanded into (host suffix, path prefix) expressions. Expressions and rules meet in an
equi-join on a short prefix of their digests; the full digest and the rule's own path confirm a hit,
and the longest rule wins. Expansion stops at the rules' greatest number of host labels and path
slashes, which loses nothing: a deeper expression equals no rule.

Defined cases: a null URL, or one without `://`, has empty host and path and meets no rule. Hosts are
compared as they stand (a port or a user name is part of the host). Rows may repeat; each is judged
alone. Rules with a null or empty host are left out, a null path counts as empty. Of two rules of one
length the longer host wins, then the block. An empty rule table gives the default verdict everywhere.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidescore.session import fits_broadcast

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
PREFIX_HEX = 8  # four bytes of the digest, as in the public safe-browsing lists


def after_scheme(url: Column) -> Column:
    at = F.instr(url, "://")
    return F.when(at > 0, F.substr(url, at + 3)).otherwise(F.lit(""))


def host_of(url: Column) -> Column:
    raw = F.regexp_extract(after_scheme(url), r"^([^/?#]*)", 1)
    return F.coalesce(F.translate(raw, UPPER, UPPER.lower()), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(after_scheme(url), r"^[^/?#]*([^?#]*)", 1), F.lit(""))


def host_suffixes(host: Column, most_labels: int) -> Column:
    labels = F.split(host, r"\.")
    counts = F.sequence(F.lit(1), F.least(F.size(labels), F.lit(most_labels)))
    return F.transform(counts, lambda n: F.concat_ws(".", F.slice(labels, F.size(labels) - n + 1, n)))


def path_prefixes(path: Column, most_slashes: int) -> Column:
    """The empty prefix and every prefix that ends with one of the first `most_slashes` slashes."""
    slashes = F.length(path) - F.length(F.translate(path, "/", ""))
    counts = F.sequence(F.lit(0), F.least(slashes, F.lit(most_slashes)))
    before = lambda n: F.call_function("substring_index", path, F.lit("/"), n)
    return F.transform(counts, lambda n: F.when(n == 0, F.lit("")).otherwise(F.concat(before(n), F.lit("/"))))


def digest(host: Column, prefix: Column) -> Column:
    return F.sha2(F.concat(host, F.lit("\n"), prefix), 256)


def prepared_rules(rules: DataFrame) -> DataFrame:
    """Rules (`host`, `path`, `verdict`) with the digest of the expression under which URLs find them."""
    path = F.coalesce(F.col("path"), F.lit(""))
    cut = F.regexp_extract(path, r"^(?s:.*/)?", 0)
    return (
        rules.where(F.col("host") != "")
        .select(F.translate("host", UPPER, UPPER.lower()).alias("rule_host"), path.alias("rule_path"),
                F.col("verdict").alias("rule_verdict"), cut.alias("rule_cut"))
        .withColumn("rule_digest", digest(F.col("rule_host"), F.col("rule_cut")))
        .withColumn("rule_key", F.substring("rule_digest", 1, PREFIX_HEX))
    )


def judge(
    pages: DataFrame, rules: DataFrame, id_col: str = "page_id", url_col: str = "url", default: str = "allow"
) -> DataFrame:
    """Per row: id, host, path, the winning rule as text (null: none) and the verdict."""
    ready = prepared_rules(rules)
    depth = ready.agg(
        F.coalesce(F.max(F.size(F.split("rule_host", r"\."))), F.lit(1)).alias("labels"),
        F.coalesce(F.max(F.length("rule_cut") - F.length(F.translate("rule_cut", "/", ""))), F.lit(0)).alias("slashes"),
    ).first()
    parts = pages.select(
        F.col(id_col).alias(id_col), host_of(F.col(url_col)).alias("host"), path_of(F.col(url_col)).alias("path")
    )
    expressions = (
        parts.select("*", F.explode(host_suffixes(F.col("host"), depth["labels"])).alias("suffix"))
        .select("*", F.explode(path_prefixes(F.col("path"), depth["slashes"])).alias("prefix"))
        .withColumn("url_digest", digest(F.col("suffix"), F.col("prefix")))
        .withColumn("url_key", F.substring("url_digest", 1, PREFIX_HEX))
    )
    small = F.broadcast(ready) if fits_broadcast(ready) else ready
    hits = expressions.join(small, F.col("url_key") == F.col("rule_key")).where(
        (F.col("url_digest") == F.col("rule_digest")) & F.col("path").startswith(F.col("rule_path"))
    )
    rank = F.struct(
        (F.length("rule_host") + F.length("rule_path")).alias("length"),
        F.length("rule_host").alias("host_length"),
        (F.col("rule_verdict") == "block").alias("blocks"),
        F.concat("rule_host", "rule_path").alias("rule"),
        F.col("rule_verdict").alias("verdict"),
    )
    best = hits.groupBy(
        F.col(id_col).alias("hit_id"), F.col("host").alias("hit_host"), F.col("path").alias("hit_path")
    ).agg(F.max(rank).alias("best"))
    return parts.join(
        best,
        parts[id_col].eqNullSafe(best["hit_id"]) & (parts["host"] == best["hit_host"])
        & (parts["path"] == best["hit_path"]),
        "left",
    ).select(
        id_col, "host", "path", F.col("best.rule").alias("rule"),
        F.coalesce(F.col("best.verdict"), F.lit(default)).alias("verdict"),
    )

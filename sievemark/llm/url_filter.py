"""URL allow and block rules by hashed host-suffix / path-prefix expressions.

Every distinct URL is expanded into the host suffixes and path prefixes that a rule
could name. Expressions meet the rules in an equi-join on a short hash prefix, the
full digest confirms, and the longest rule wins. All of it is DataFrame functions.

Edge cases: a null URL or one without ``://`` has empty host and path; such a URL,
and one that no rule fits, gets the default verdict. Repeated URLs are judged once
and keep all their rows. Columns of the input pass through untouched unless they
bear the name of an output column, which then replaces them. An empty table gives
an empty result.
"""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import ascii_lower

#: Rules (verdict, host, path) that the query applies.
RULES = [("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"), ("allow", "org", "/fr/")]
#: Hex digits of the digest on which expressions and rules are joined.
PREFIX_DIGITS = 8
#: A larger rule table is joined by shuffling instead of broadcasting it.
BROADCAST_BYTES = 16_000_000


def url_host(url: Column) -> Column:
    """Between the first ``://`` and the next ``/``, ``?``, ``#`` or the end, A-Z lower-cased; else empty."""
    return F.coalesce(F.when(F.instr(url, "://") > 0, ascii_lower(F.regexp_extract(_after_scheme(url), "^[^/?#]*", 0))), F.lit(""))


def url_path(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end; empty without ``://``."""
    return F.coalesce(F.when(F.instr(url, "://") > 0, F.regexp_extract(_after_scheme(url), "^[^/?#]*([^?#]*)", 1)), F.lit(""))


def _after_scheme(url: Column) -> Column:
    return F.substring(url, F.instr(url, "://") + F.lit(3), F.length(url))


def _digest(expression: Column) -> Column:
    return F.sha2(expression, 256)


def rule_table(rules: DataFrame) -> DataFrame:
    """Rows (prefix, digest, rule, verdict) from rows (verdict, host, path); of a rule named twice block wins."""
    named = rules.select("verdict", ascii_lower(F.col("host")).alias("host"), "path")
    t = named.groupBy(F.concat("host", "path").alias("rule"), _digest(F.concat_ws("\n", "host", "path")).alias("digest")).agg(F.max("verdict").alias("verdict"))
    return t.select(F.substring("digest", 1, PREFIX_DIGITS).alias("prefix"), "digest", "rule", "verdict")


def judge(pages: DataFrame, rules: Sequence[tuple[str, str, str]] | DataFrame = RULES, url: str = "url", default: str = "allow") -> DataFrame:
    """``pages`` with columns host, path, rule (null if none fits) and verdict added.

    ``rules`` are rows (verdict, host, path), few as a list or any number as a table. A rule
    fits its host and all subdomains if the path starts with the rule's path; of several
    the longest wins (as text ``host + path``; ties cannot differ in text).
    """
    made = ("host", "path", "rule", "verdict")
    # The other columns travel in one, so none of their names can clash.
    kept = pages.select(F.struct(*[F.col(c) for c in pages.columns]).alias("row"), F.col(url).alias("url"))
    if not isinstance(rules, DataFrame):
        listed = F.from_json(F.lit(json.dumps([{"verdict": v, "host": h, "path": p} for v, h, p in rules])), "array<struct<verdict:string,host:string,path:string>>")
        rules = pages.sparkSession.range(1).select(F.explode(listed).alias("r")).select("r.*")  # one literal, no Python rows
    table = rule_table(rules)
    shape = rules.agg(F.max(F.size(F.split("host", r"\."))).alias("labels"), F.collect_set(F.length("path")).alias("lengths"), F.sum(F.length("host") + F.length("path") + 80).alias("bytes")).first()
    lengths = sorted(shape["lengths"])  # the lengths of a rule's path that occur
    urls = kept.select(F.col("url").alias("u")).filter("u is not null").distinct()
    urls = urls.select("u", url_host(F.col("u")).alias("h"), url_path(F.col("u")).alias("p"))
    names = F.split("h", r"\.", -1)
    suffixes = F.transform(F.sequence(F.lit(1), F.least(F.size(names), F.lit(shape["labels"] or 1))), lambda n: F.array_join(F.slice(names, F.size(names) - n + 1, n), "."))
    prefixes = F.array_distinct(F.transform(F.lit(lengths).cast("array<int>"), lambda n: F.substring("p", F.lit(1), n)))
    expressions = F.flatten(F.transform(suffixes, lambda s: F.transform(prefixes, lambda p: _digest(F.concat_ws("\n", s, p)))))
    expanded = urls.select("u", F.explode(F.array_distinct(expressions)).alias("full")).withColumn("prefix", F.substring("full", 1, PREFIX_DIGITS))
    hits = expanded.join(F.broadcast(table) if (shape["bytes"] or 0) <= BROADCAST_BYTES else table, "prefix").filter("full = digest")
    best = hits.groupBy("u").agg(F.max_by(F.struct("rule", "verdict"), F.struct(F.length("rule"), "rule")).alias("best"))
    joined = kept.join(best, F.col("url") == F.col("u"), "left")
    return joined.select(*[F.col("row").getField(c).alias(c) for c in pages.columns if c not in made], *_judged(default))


def _judged(default: str) -> list[Column]:
    return [url_host(F.col("url")).alias("host"), url_path(F.col("url")).alias("path"), F.col("best.rule").alias("rule"), F.coalesce("best.verdict", F.lit(default)).alias("verdict")]

"""URL filters: fixed rules, and association rules mined from what they label.

A fixed rule ``(host, path, verdict)`` fits its host and all subdomains where
the url's path starts with the rule's; the longest rule wins. Urls that a rule
decides are the labels of the method. Spark's FP-growth mines the token
combinations of these urls; a combination becomes a rule if it is frequent,
one verdict holds in at least ``CONFIDENCE`` of its urls, and it is closed (no
larger combination has the same urls, so nothing all of them share is left
out). A url that no fixed rule decides gets the verdict of its best mined rule
(confidence, then support, then size), or ``DEFAULT``.

Matching is an inverted index, token to rules: a rule matches where the url
has all of its tokens. Only tokens of the index count, so the index is joined
once for each distinct set of them (few, whatever the number of pages) and
the verdict goes back by that set. All of it is DataFrame expressions.

Tokens: labels of the host, segments of the path (digits as ``#``) and keys of
the query, each marked with its place.

Fit: ``MAX_LABELLED`` distinct labelled urls, drawn by their hash, and
``MAX_ITEMS`` tokens of each (the most frequent). Both bound the model only;
every url is judged.

Defined cases: a null url, or one without ``://``, has an empty host and path
and no tokens, so it gets ``DEFAULT``; repeated rows are judged alike; no
labelled url, or an empty table, mines no rule; other columns are ignored.
"""

from __future__ import annotations

import math

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from blotter.llm.common import saved

#: Fixed values of the contract: host, path and verdict of each rule.
RULES = (
    ("net", "/", "block"),
    ("example.net", "/en/", "allow"),
    ("example.com", "/de/", "block"),
    ("org", "/fr/", "allow"),
)
DEFAULT = "allow"

MAX_LABELLED = 100_000
MAX_ITEMS = 12
SUPPORT = 0.02
MIN_URLS = 3
CONFIDENCE = 0.8

#: Partitions of the mining, whose input is bounded.
MINING_PARTITIONS = 8

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _lower(c: Column) -> Column:
    return F.translate(c, _UPPER, _LOWER)


def _rest(url: Column) -> Column:
    """What follows the first ``://``; empty without it."""
    at = F.instr(url, "://")
    return F.coalesce(F.when(at > 0, F.substring(url, at + 3, F.length(url))), F.lit(""))


def host_of(url: Column) -> Column:
    return _lower(F.regexp_extract(_rest(url), r"^([^/?#]*)", 1))


def path_of(url: Column) -> Column:
    return F.regexp_extract(_rest(url), r"^[^/?#]*([^?#]*)", 1)


def tokens_of(url: Column) -> Column:
    """The distinct tokens of a url."""
    query = F.regexp_extract(_rest(url), r"^[^?#]*\?([^#]*)", 1)

    def marked(parts: Column, mark: str) -> Column:
        return F.transform(F.filter(parts, lambda p: p != ""), lambda p: F.concat(F.lit(mark), p))

    keys = F.transform(F.split(query, "&"), lambda p: F.substring_index(p, "=", 1))
    segments = F.split(F.regexp_replace(_lower(path_of(url)), "[0-9]+", "#"), "/")
    return F.array_distinct(F.concat(
        marked(F.split(host_of(url), r"\."), "host "), marked(segments, "path "), marked(keys, "query "),
    ))


def with_rule(pages: DataFrame, rules=RULES) -> DataFrame:
    """``page_id, url, host, path, rule, fixed`` (the verdict of the rule)."""
    url = F.col("url").cast("string")
    out = pages.select("page_id", url.alias("url"), host_of(url).alias("host"), path_of(url).alias("path"))
    rule = verdict = None
    # The longest rule that fits is the first one in this order.
    for host, path, what in sorted(rules, key=lambda r: (-len(r[0] + r[1]), r)):
        fits = ((F.col("host") == host) | F.col("host").endswith(f".{host}")) & F.col("path").startswith(path)
        rule = F.when(fits, host + path) if rule is None else rule.when(fits, host + path)
        verdict = F.when(fits, what) if verdict is None else verdict.when(fits, what)
    empty = F.lit(None).cast("string")
    return out.withColumn("rule", empty if rule is None else rule).withColumn("fixed", empty if verdict is None else verdict)


def training_urls(ruled: DataFrame, max_labelled: int = MAX_LABELLED) -> DataFrame:
    """``url, fixed, tokens`` of the distinct urls that a rule decides, about
    ``max_labelled`` of them, drawn by their hash."""
    known = ruled.where("fixed is not null").groupBy("url").agg(F.min("fixed").alias("fixed"))
    n = known.count()
    place = F.conv(F.substring(F.md5("url"), 1, 8), 16, 10).cast("bigint")
    drawn = known if n <= max_labelled else known.where(place < int(max_labelled / n * 16**8))
    return drawn.withColumn("tokens", tokens_of(F.col("url")))


def transactions(urls: DataFrame, least: int, max_items: int = MAX_ITEMS) -> DataFrame:
    """``items`` of each url: its tokens that ``least`` urls or more have, the
    ``max_items`` most frequent, and its verdict."""
    found = urls.select("url", "fixed", F.explode("tokens").alias("token"))
    counts = found.groupBy("token").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= least)
    order = F.array_sort(F.collect_list(F.struct((-F.col("n")).alias("n"), "token")))
    kept = found.join(counts, "token").groupBy("url", "fixed").agg(F.slice(order, 1, max_items).alias("best"))
    return kept.select(F.concat(F.col("best.token"), F.array(F.concat(F.lit("verdict "), "fixed"))).alias("items"))


def mined_rules(
    ruled: DataFrame, max_labelled: int = MAX_LABELLED, support: float = SUPPORT, min_urls: int = MIN_URLS,
    confidence: float = CONFIDENCE, max_items: int = MAX_ITEMS,
) -> DataFrame | None:
    """``tokens, verdict, n, confidence`` of the rules; None if there is none."""
    urls, _ = saved(training_urls(ruled, max_labelled), "url-labelled")
    total = urls.count()
    least = max(min_urls, math.ceil(support * total))
    rows, _ = saved(transactions(urls, least, max_items), "url-items")
    n = rows.count()
    if n < least:
        return None
    # The miner takes a share and rounds its count up.
    model = FPGrowth(itemsCol="items", minSupport=(least - 0.5) / n, numPartitions=MINING_PARTITIONS).fit(rows)
    sets, _ = saved(
        model.freqItemsets.select(
            F.array_sort(F.filter("items", lambda t: ~t.startswith("verdict "))).alias("tokens"),
            F.array_join(F.filter("items", lambda t: t.startswith("verdict ")), "").alias("verdict"),
            F.col("freq").alias("n"),
        ),
        "url-itemsets",
    )
    plain = sets.where("verdict = '' and size(tokens) > 0").select("tokens", F.col("n").alias("with_tokens"))
    smaller = plain.select(F.explode("tokens").alias("one"), "tokens", "with_tokens").select(
        F.array_remove("tokens", F.col("one")).alias("tokens"), "with_tokens"
    )
    largest = smaller.groupBy("tokens").agg(F.max("with_tokens").alias("next"))
    closed = plain.join(largest, "tokens", "left").where("next is null or next < with_tokens").drop("next")
    judged = sets.where("verdict <> ''").select("tokens", F.substring_index("verdict", " ", -1).alias("verdict"), "n")
    share = F.col("n") / F.col("with_tokens")
    return judged.join(closed, "tokens").withColumn("confidence", share).where(share >= confidence).select(
        "tokens", "verdict", "n", "confidence"
    )


def judged(pages: DataFrame, rules=RULES, default: str = DEFAULT, **fit) -> DataFrame:
    """``page_id, host, path, rule, verdict, mined`` (the tokens of the mined
    rule that decided, if one did)."""
    ruled = with_rule(pages, rules)
    found = mined_rules(ruled, **fit)
    none = F.lit(None).cast("string")
    columns = ["page_id", "host", "path", "rule"]
    if found is None:
        return ruled.select(*columns, F.coalesce("fixed", F.lit(default)).alias("verdict"), none.alias("mined"))
    found, _ = saved(found, "url-rules")
    index = found.select(
        F.explode("tokens").alias("token"), F.col("tokens").alias("of"), "verdict", "n", "confidence",
    )
    # Tokens of the index: at most 1 / SUPPORT times the tokens of a url.
    known = [r["token"] for r in index.select("token").distinct().collect()]
    open_urls = F.when(F.col("fixed").isNull(), F.array_sort(F.filter(tokens_of(F.col("url")), lambda t: t.isin(known))))
    tagged = ruled.withColumn("held", open_urls)
    sets = tagged.where(F.size("held") > 0).select("held").distinct()
    hits = sets.select("held", F.explode("held").alias("token")).join(index, "token")
    whole = hits.groupBy("held", "of", "verdict", "n", "confidence").agg(F.count(F.lit(1)).alias("has")).where(
        F.col("has") == F.size("of")
    )
    order = F.struct("confidence", "n", F.size("of").alias("size"), F.array_join("of", "\n").alias("text"), "verdict")
    best = whole.groupBy("held").agg(F.max(order).alias("best"))
    return tagged.join(best, "held", "left").select(
        *columns, F.coalesce("fixed", "best.verdict", F.lit(default)).alias("verdict"),
        F.col("best.text").alias("mined"),
    )

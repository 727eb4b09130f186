"""URL filters by a sort-merge range join, in DataFrame operations only.

A host is turned round by its labels, so rule ``example.com/en/`` has the canonical key
``com.example/en/`` and fits every key in the byte interval from it to ``com.example/en/\\xff``.
A url has one key for each suffix of its host (subdomains) that is as long as some rule's host.
Opening and closing bounds of the rules are sorted together with the url keys, per rule host and
salt, and swept once: the number of open bounds is the height of the stack, level j of the stack
is the rule last opened at height j, and the url takes the top. Of the tops of its suffixes the
longest rule wins (host and path together; then the longer host, then the smaller text).

Equal (host, path) pairs are swept once. The urls of a rule host are counted, and swept in as many slices as hold
about ``slice_urls`` each, or eight times the bounds of the host's rules if that is more; the rules of the host are copied
to each slice.

Defined results: a null url or one without ``://`` has an empty host and path, no rule, and the
default verdict; repeated rows are judged alike; of two rules for one place ``block`` wins; with no
rules or no pages the result is made of defaults or empty; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: The rules of the contract: host, path, verdict.
RULES = (("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"), ("net", "/es/", "block"), ("net", "/fr/", "block"))


def host_of(url: Column) -> Column:
    rest = F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit(""))
    return F.translate(rest, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def _turned(host: str) -> str:
    return f"reverse(split({host}, '[.]'))"


def _bounds(rules: DataFrame) -> DataFrame:
    """Two rows a rule: place (turned host), key (bytes), step (+1 or -1), rule, verdict."""
    one = rules.groupBy("host", "path").agg(F.max("verdict").alias("verdict"))
    one = one.select(F.expr(f"array_join({_turned('host')}, '.')").alias("place"), F.col("path"), F.concat("host", "path").alias("rule"), "verdict")
    key = F.concat("place", "path").cast("binary")
    return one.select("place", F.explode(F.array(F.struct(key.alias("key"), F.lit(1).alias("step")), F.struct(F.concat(key, F.lit(b"\xff")).alias("key"), F.lit(-1).alias("step")))).alias("e"), "rule", "verdict").select("place", "e.*", "rule", "verdict")


def judge_urls(pages: DataFrame, rules: DataFrame, id_col: str = "page_id", url_col: str = "url", default: str = "allow", slice_urls: int = 4096) -> DataFrame:
    """``(page_id, host, path, rule, verdict)`` for every row of ``pages``; ``rules`` has host, path and verdict."""
    bounds = _bounds(rules)
    up = Window.partitionBy("place").orderBy("key", F.desc("step"))
    shape = bounds.withColumn("height", F.sum("step").over(up)).agg(F.max("height").alias("height"), F.max(F.expr("size(split(place, '[.]'))")).alias("labels")).first()
    height, labels = shape["height"] or 1, shape["labels"] or 1  # two numbers: nesting and longest host of the rules

    rows = pages.select(F.col(id_col).alias("page_id"), host_of(F.col(url_col)).alias("host"), path_of(F.col(url_col)).alias("path"))
    urls = rows.select("host", "path").distinct()
    places = urls.withColumn("labels", F.expr(_turned("host"))).withColumn("k", F.explode(F.expr(f"sequence(1, least(size(labels), {labels}))")))
    places = places.select("host", "path", F.expr("array_join(slice(labels, 1, k), '.')").alias("place"))
    places = places.join(bounds.select("place").distinct(), "place", "left_semi")
    own = bounds.groupBy("place").agg(F.count("*").alias("bounds"))
    slices = F.ceil(F.col("urls") / F.greatest(F.lit(slice_urls), F.col("bounds") * 8)).cast("int")
    hot = places.groupBy("place").agg(F.count("*").alias("urls")).join(own, "place").select("place", slices.alias("slices")).where("slices > 1")
    places = places.join(hot, "place", "left").withColumn("slices", F.coalesce("slices", F.lit(1)))
    asked = places.select("place", F.pmod(F.xxhash64("host", "path"), F.col("slices")).cast("int").alias("salt"), F.concat("place", "path").cast("binary").alias("key"), F.lit(0).alias("step"), F.lit(None).cast("string").alias("rule"), F.lit(None).cast("string").alias("verdict"), "host", "path")
    copied = bounds.join(hot, "place", "left").withColumn("salt", F.explode(F.sequence(F.lit(0), F.coalesce("slices", F.lit(1)) - 1))).drop("slices").withColumns({"host": F.lit(None).cast("string"), "path": F.lit(None).cast("string")})

    sweep = Window.partitionBy("place", "salt").orderBy("key", F.desc("step")).rowsBetween(Window.unboundedPreceding, 0)
    swept = asked.unionByName(copied).withColumn("height", F.sum("step").over(sweep))
    levels = [F.last(F.when((F.col("step") == 1) & (F.col("height") == j), F.struct("rule", "verdict")), ignorenulls=True).over(sweep) for j in range(1, height + 1)]
    top = F.try_element_at(F.array(*levels), F.when(F.col("height") > 0, F.col("height").cast("int")))
    hit = swept.withColumn("top", top).where("step = 0 and top is not null")
    best = hit.groupBy("host", "path").agg(F.max(F.struct(F.length("top.rule").alias("n"), F.length("place").alias("h"), F.col("top"))).alias("best"))
    best = best.select("host", "path", F.col("best.top.rule").alias("rule"), F.col("best.top.verdict").alias("verdict"))
    return rows.join(best, ["host", "path"], "left").select("page_id", "host", "path", "rule", F.coalesce("verdict", F.lit(default)).alias("verdict"))

"""URL filter: fixed rules first, then a character model of accepted against one of rejected URLs.

The URLs that a rule decides are the training texts. Every character is predicted from the three before it by two
Markov models with Witten-Bell smoothing: a context that was never seen hands over to the next shorter one, so the
order varies from character to character. A URL's score is the log-likelihood difference per character; the threshold
is the one with the best balanced accuracy on a fifth of the decided URLs, which the models have not seen.

Both models live in one table over the distinct four-character strings of all URLs: counts are summed before the
shuffle, shorter strings are sums of longer ones, and scoring is one lookup per character. The table grows with the
variety of strings, not with the rows; its size is counted, and beyond ``BROADCAST_ROWS`` the lookup is a sort-merge
join, where adaptive execution splits frequent strings. Equal URLs are scored once. Differences are rounded to whole
micro-nats and added as integers, so a score does not depend on the order of rows. Built-in functions only.

Defined results: null, empty, or without ``://``: empty host and path, no rule; null and empty URLs are blocked, others
are scored like any text. Repeated rows each get the verdict. With only one class decided the threshold is 0. An empty
table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ordermart.llm.frames import Scratch, ascii_lower, free_name

# The contract's rules, verdict by host and path.
RULES = {
    "com/": "allow",
    "example.com/en/": "block",
    "www.example.com/en/": "allow",
    "net/es/": "block",
    "net/fr/": "block",
}
ORDER = 4
START, END = "\u0002" * (ORDER - 1), "\u0003"
FOLDS = 5
ALPHABET = 256.0
MICRO = 1_000_000
BROADCAST_ROWS = 200_000


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host and path as text; both empty without ``://``."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + F.lit(3), F.length(url))).otherwise("")
    rest = F.coalesce(rest, F.lit(""))
    return ascii_lower(F.regexp_extract(rest, "^[^/?#]*", 0)), F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1)


def rule_of(host: Column, path: Column, rules: dict[str, str] = RULES) -> Column:
    """The longest rule that fits, null if none does."""
    found = F.lit(None).cast("string")
    for rule in sorted(rules, key=len):
        name, _, start = rule.partition("/")
        fits = ((host == name) | host.endswith(f".{name}")) & path.startswith(f"/{start}")
        found = F.when(fits, F.lit(rule)).otherwise(found)
    return found


def verdict_of(rule: Column, rules: dict[str, str] = RULES) -> Column:
    found = F.lit(None).cast("string")
    for name, verdict in rules.items():
        found = F.when(rule == name, F.lit(verdict)).otherwise(found)
    return found


def _grams(urls: DataFrame, *keep: str) -> DataFrame:
    """A row per character: the string of it and the three before it.

    The URL is split into characters once and joined by place, so a long one costs as much a character as a short one.
    """
    padded = F.concat(F.lit(START), F.col("url"), F.lit(END))
    split = urls.select(*keep, F.regexp_extract_all(padded, F.lit("(?s)."), F.lit(0)).alias("chars"))
    gram = lambda i: F.concat(*[F.get("chars", i + k) for k in range(ORDER)])
    grams = F.transform(F.sequence(F.lit(0), F.size("chars") - ORDER), gram)
    return split.select(*keep, F.explode(grams).alias("gram"))


def _level(grams: DataFrame, order: int) -> DataFrame:
    """Strings of one length: context, counts, and the context's total and number of followers, for both classes."""
    level = (
        grams.groupBy(F.expr(f"right(gram, {order})").alias("gram"))
        .agg(F.sum("accepted").alias("accepted"), F.sum("rejected").alias("rejected"))
        .withColumn("context", F.expr(f"left(gram, {order - 1})"))
    )
    of_context = level.groupBy("context").agg(
        *[F.sum(c).alias(f"{c}_total") for c in ("accepted", "rejected")],
        *[F.sum((F.col(c) > 0).cast("long")).alias(f"{c}_kinds") for c in ("accepted", "rejected")],
    )
    return level.join(of_context, "context")


def _smoothed(count: str, shorter: Column) -> Column:
    """Witten-Bell: the shorter context's probability weighs as much as there are followers."""
    total, kinds = F.col(f"{count}_total"), F.col(f"{count}_kinds")
    return F.when(total > 0, (F.col(count) + kinds * shorter) / (total + kinds)).otherwise(shorter)


def character_model(urls: DataFrame, scratch: Scratch) -> DataFrame:
    """(gram, gain): log-likelihood of accepted over rejected for the last character, in micro-nats.

    urls: distinct ``url`` with the numbers of ``accepted`` and ``rejected`` training rows; all strings that occur are
    in the result, also those of URLs without training rows.
    """
    counted = _grams(urls, "accepted", "rejected").groupBy("gram").agg(F.sum("accepted").alias("accepted"), F.sum("rejected").alias("rejected"))
    grams = scratch.write(counted, "grams")
    model = None
    for order in range(1, ORDER + 1):
        level = _level(grams, order)
        if model is not None:
            level = level.withColumn("suffix", F.expr(f"right(gram, {order - 1})")).join(model, "suffix")
        shorter = {c: F.lit(1 / ALPHABET) if model is None else F.col(f"{c}_p") for c in ("accepted", "rejected")}
        found = level.select("gram", *[_smoothed(c, shorter[c]).alias(f"{c}_p") for c in ("accepted", "rejected")])
        model = found.withColumnRenamed("gram", "suffix")
    gain = F.round((F.log("accepted_p") - F.log("rejected_p")) * MICRO).cast("long")
    return scratch.write(model.select(F.col("suffix").alias("gram"), gain.alias("gain")), "model")


def _threshold(scored: DataFrame) -> float:
    """Score with the best balanced accuracy on the held-out decided URLs. scored: score, accepted, rejected."""
    bins = (
        scored.groupBy(F.least(F.lit(20_000), F.greatest(F.lit(-20_000), F.floor(F.col("score") * 1000))).alias("bin"))
        .agg(F.sum("accepted").alias("accepted"), F.sum("rejected").alias("rejected"))
        .withColumn("low", F.sum("rejected").over(Window.orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)))
        .withColumn("high", F.sum("accepted").over(Window.orderBy("bin").rowsBetween(0, Window.unboundedFollowing)))
        .withColumn("all_accepted", F.sum("accepted").over(Window.partitionBy(F.lit(1))))
        .withColumn("all_rejected", F.sum("rejected").over(Window.partitionBy(F.lit(1))))
    )  # at most 40,001 rows, whatever the table
    share = F.coalesce("low", F.lit(0)) / F.col("all_rejected") + F.col("high") / F.col("all_accepted")
    best = bins.where("all_accepted > 0 and all_rejected > 0").orderBy(share.desc(), F.abs("bin"), "bin").select("bin").head()
    return best["bin"] / 1000 if best else 0.0


def url_filter(pages: DataFrame, url: str = "url", rules: dict[str, str] = RULES) -> DataFrame:
    """``pages`` with host, path, rule, score (null where a rule decides) and verdict as a struct column ``judged``."""
    scratch = Scratch(pages.sparkSession)
    host, path = host_and_path(F.col("url"))
    rule = rule_of(F.col("host"), F.col("path"), rules)
    counted = (
        pages.where(pages[url].isNotNull())
        .groupBy(pages[url].alias("url"))
        .agg(F.count("*").alias("n"))
        .select("url", "n", host.alias("host"), path.alias("path"))
        .withColumn("rule", rule)
        .withColumn("fixed", verdict_of(F.col("rule"), rules))
        .withColumn("held", F.pmod(F.xxhash64("url"), F.lit(FOLDS)) == 0)
        # Rows per character carry this number and not the URL.
        .withColumn("uid", F.monotonically_increasing_id())
    )
    urls = scratch.write(counted, "urls")
    times = lambda verdict, held: F.when((F.col("fixed") == verdict) & (F.col("held") == held), F.col("n")).otherwise(0)
    model = character_model(urls.select("url", times("allow", False).alias("accepted"), times("block", False).alias("rejected")), scratch)
    if model.count() <= BROADCAST_ROWS:
        model = F.broadcast(model)
    to_score = urls.where(F.col("fixed").isNull() | F.col("held"))
    score = F.sum("gain") / F.count("*") / MICRO
    scored = scratch.write(
        _grams(to_score, "uid").join(model, "gram").groupBy("uid").agg(score.alias("score")), "scored"
    )
    held = urls.where("fixed is not null and held").select(
        "uid", times("allow", True).alias("accepted"), times("block", True).alias("rejected")
    )
    threshold = _threshold(scored.join(held, "uid"))
    by_model = F.when((F.col("score") >= threshold) & (F.col("url") != ""), "allow").otherwise("block")
    judged = urls.join(scored, "uid", "left").select(
        F.col("url").alias(free_name("judged_url", pages)),
        F.struct(
            "host", "path", "rule", F.when(F.col("fixed").isNull(), F.col("score")).alias("score"), F.coalesce("fixed", by_model).alias("verdict")
        ).alias(free_name("judged", pages)),
    )
    key, found = judged.columns
    nothing = F.struct(
        F.lit("").alias("host"), F.lit("").alias("path"), F.lit(None).cast("string").alias("rule"), F.lit(None).cast("double").alias("score"), F.lit("block").alias("verdict")
    )
    return pages.join(judged, pages[url] == judged[key], "left").drop(key).withColumn(found, F.coalesce(found, nothing))


def op7_url_filters(spark, sf_dir: str) -> DataFrame:
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url")
    return url_filter(pages).select("page_id", "judged.host", "judged.path", "judged.rule", "judged.verdict", "judged.score")

"""URL filter: host rules, and for the rest a character language-model ratio.

Two variable-order Markov models over the characters of ``host + path``, one
of the URLs that rules allow and one of those that rules block, interpolate
orders 0 to 3 by Witten-Bell weights (an unseen context backs off to the next
shorter one).  A URL's score is the mean over its characters of
``log p_allow - log p_block``; the cut between the verdicts is calibrated on
labelled URLs that the models have not seen.  Everything is joins and
aggregates over distinct character n-grams; nothing leaves the JVM.

Defined cases: a null URL or one without ``://`` has empty host and path and
is scored as the empty string; repeated URLs train once; without labelled
URLs of a class its model is uniform; without calibration URLs the cut is 0;
an empty table gives an empty result.  A very long URL is read whole; its time
grows with the square of its length, as each of its grams is cut out anew, its
bytes only with the length.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adresponse.llm.store import keep, own_columns

ORDER = 3  # longest context in characters
CALIBRATION_FOLDS = 5
PAD, END = "\u0002", "\u0003"
#: (verdict, host, path prefix)
RULES = (
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
)


def parts(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path of a URL; both empty without ``://``."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, url.substr(at + 3, F.length(url))).otherwise(F.lit(""))
    rest = F.coalesce(rest, F.lit(""))
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    host = F.translate(F.regexp_extract(rest, r"^([^/?#]*)", 1), upper, upper.lower())
    return host, F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def apply_rules(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """The longest rule that fits, and its verdict; null where none does."""
    rule = verdict = F.lit(None).cast("string")
    for kind, h, p in sorted(rules, key=lambda r: len(r[1]) + len(r[2])):  # the longest is asked first
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        rule = F.when(fits, F.lit(h + p)).otherwise(rule)
        verdict = F.when(fits, F.lit(kind)).otherwise(verdict)
    return rule, verdict


def _char_model(grams: DataFrame, order: int) -> DataFrame:
    """(gram, ratio): log p_allow - log p_block of a gram's last character after the others.

    ``grams`` has every distinct gram of ``order + 1`` characters with its
    training counts ``a`` (allowed) and ``b`` (blocked).
    """
    chars = grams.groupBy(F.expr("right(gram, 1)").alias("g")).agg(F.sum("a").alias("a"), F.sum("b").alias("b"))
    total = chars.agg(F.count("g").alias("kinds"), F.coalesce(F.sum("a"), F.lit(0)).alias("a"), F.coalesce(F.sum("b"), F.lit(0)).alias("b")).first()
    uniform = 1.0 / (total.kinds + 1)
    level = chars.select("g", *[((F.col(c) + uniform) / (n + 1)).alias(f"p{c}") for c, n in (("a", total.a), ("b", total.b))])
    for k in range(2, order + 2):
        here = grams.groupBy(F.expr(f"right(gram, {k})").alias("g")).agg(F.sum("a").alias("a"), F.sum("b").alias("b"))
        here = here.withColumns({"ctx": F.expr(f"left(g, {k - 1})"), "tail": F.expr(f"right(g, {k - 1})")})
        seen = here.groupBy("ctx").agg(
            *[F.sum(c).alias(f"n{c}") for c in "ab"], *[F.sum((F.col(c) > 0).cast("long")).alias(f"t{c}") for c in "ab"]
        )
        shorter = level.withColumnRenamed("g", "tail")
        level = here.join(seen, "ctx").join(shorter, "tail").select(
            "g",
            *[
                F.when(F.col(f"n{c}") > 0, (F.col(c) + F.col(f"t{c}") * F.col(f"p{c}")) / (F.col(f"n{c}") + F.col(f"t{c}")))
                .otherwise(F.col(f"p{c}")).alias(f"p{c}")
                for c in "ab"
            ],
        )
    return level.select(F.col("g").alias("gram"), (F.log("pa") - F.log("pb")).alias("ratio"))


def filter_urls(pages: DataFrame, rules=RULES, order: int = ORDER, folds: int = CALIBRATION_FOLDS) -> DataFrame:
    """page_id, host, path, rule, verdict, score and cut of every row of ``pages``."""
    host, path = parts(F.col("url"))
    rows = own_columns(pages, "page_id", "url").select("page_id", host.alias("host"), path.alias("path"))
    urls = rows.select("host", "path").distinct()
    rule, verdict = apply_rules(F.col("host"), F.col("path"), rules)
    whole = F.concat("host", F.lit("\u0001"), "path")
    # 0: trains; 1: calibrates
    fold = (F.crc32(whole.cast("binary")) % folds == 0).cast("int")
    urls = keep(urls.select("host", "path", F.xxhash64("host", "path").alias("url_id"), F.hash("host", "path").alias("url_key"), rule.alias("rule"), verdict.alias("ruled"), fold.alias("fold")), "urls")
    padded = F.concat(F.lit(PAD * order), "host", "path", F.lit(END))
    own = ["url_id", "url_key"]  # 96 bits: a row for each character carries no text but its gram
    places = urls.select(
        *own, "ruled", "fold",
        F.explode(F.transform(F.sequence(F.lit(1), F.length("host") + F.length("path") + 1), lambda i: F.substr(padded, i, F.lit(order + 1)))).alias("gram"),
    )
    train = lambda kind: F.sum(((F.col("ruled") == kind) & (F.col("fold") == 0)).cast("long"))
    grams = keep(places.groupBy("gram").agg(F.coalesce(train("allow"), F.lit(0)).alias("a"), F.coalesce(train("block"), F.lit(0)).alias("b")), "url-grams")
    ratio = _char_model(grams, order)
    means = places.select(*own, "gram").join(ratio, "gram").groupBy(*own).agg(F.avg("ratio").alias("score"))
    scored = keep(urls.join(means, own), "url-scores")
    by = {r.ruled: r for r in scored.where("fold = 1 and ruled is not null").groupBy("ruled").agg(F.avg("score").alias("m"), F.stddev_pop("score").alias("s")).collect()}
    cut = 0.0
    if len(by) == 2:  # as many standard deviations from either class
        a, b = by["allow"], by["block"]
        cut = (a.m * b.s + b.m * a.s) / (a.s + b.s) if a.s + b.s > 0 else (a.m + b.m) / 2
    judged = scored.select(
        "host", "path", "rule", F.coalesce("ruled", F.when(F.col("score") >= cut, "allow").otherwise("block")).alias("verdict"), "score"
    )
    return rows.join(judged, ["host", "path"]).select("page_id", "host", "path", "rule", "verdict", "score", F.lit(cut).alias("cut"))

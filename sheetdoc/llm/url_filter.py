"""URL filter: host and path rules, and a character language-model ratio for the URLs that no
rule fits (DataFrame functions only).

Two variable-order Markov models over characters, one of accepted and one of rejected URLs, are
learned from URLs that the rules decide. A character's probability after its context of k
characters mixes the context's own counts with the estimate after the k - 1 nearer characters
(Witten-Bell smoothing), down to a uniform alphabet; each model keeps the contexts it has seen, so
the order varies from place to place. A URL scores the mean over its characters of the difference
of log probabilities, and is accepted from a threshold calibrated on all rule-decided URLs, each
scored by models that were learned without its fold.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sheetdoc.llm.common import stage

#: Longest context, in characters.
ORDER = 4
#: Grams whose ratios a scoring join broadcasts, at most (about 10 MB): the most frequent ones. The
#: places of the others are joined by shuffle.
BROADCAST_GRAMS = 100_000
#: Characters that a smoothed model reckons with.
ALPHABET = 256
#: Folds of the labelled URLs (by a hash of the URL): to calibrate the threshold, each is scored by
#: models that learned from the others. The models that judge learn from all.
FOLDS = 2
#: Cells of a unit of score, by which running counts over all scores are summed up first.
CELLS = 1 << 10

Rule = tuple[str, str]  # ("allow" or "block", "host/path")


def ascii_lower(c: Column) -> Column:
    return F.translate(c, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def with_host_and_path(pages: DataFrame, url: str = "url") -> DataFrame:
    """``host``: after the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased;
    ``path``: then up to ``?``, ``#`` or the end. Both empty for a null URL or one without ``://``."""
    at = F.locate("://", F.col(url))
    rest = F.when(at > 0, F.substring(F.col(url), at + 3, F.length(url))).otherwise("")
    host = F.regexp_extract(rest, r"^([^/?#]*)", 1)
    return (
        pages.withColumn("host", F.coalesce(ascii_lower(host), F.lit("")))
        .withColumn("path", F.coalesce(F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1), F.lit("")))
    )


def with_rule(pages: DataFrame, rules: list[Rule]) -> DataFrame:
    """``rule`` (text of the longest rule that fits ``host`` and ``path``, else null) and
    ``rule_verdict``. A rule fits its host and all subdomains of it."""
    text, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for kind, rule in sorted(rules, key=lambda r: (len(r[1]), r[1])):  # the longest is asked first
        domain, _, path = rule.partition("/")
        fits = ((F.col("host") == domain) | F.col("host").endswith("." + domain)) & F.col("path").startswith("/" + path)
        text = F.when(fits, F.lit(rule)).otherwise(text)
        verdict = F.when(fits, F.lit(kind)).otherwise(verdict)
    return pages.withColumn("rule", text).withColumn("rule_verdict", verdict)


def _line(url: str) -> Column:
    """What the models read: the URL after its scheme, A-Z lower-cased, marked at the start."""
    plain = ascii_lower(F.regexp_replace(F.coalesce(F.col(url), F.lit("")), r"^[^:/?#]*://", ""))
    return F.when(F.length(plain) > 0, F.concat(F.lit("\x02" * ORDER), plain)).otherwise("")


def _places(lines: DataFrame) -> DataFrame:
    """One row per character of ``line``: ``g0`` .. ``gORDER``, the character with 0 .. ORDER
    characters before it."""
    at = lines.withColumn("_at", F.explode(F.sequence(F.lit(ORDER + 1), F.length("line"))))
    grams = [F.substring(F.col("line"), F.col("_at") - k, F.lit(k + 1)).alias(f"g{k}") for k in range(ORDER + 1)]
    return at.select(*(c for c in lines.columns if c != "line"), *grams)


def train(labelled: DataFrame, line: str = "line") -> list[DataFrame]:
    """Tables ``gram -> ratio`` for contexts of 0 .. ORDER characters: the smoothed log
    probability of the gram's last character after the others under the accepting model, less that
    under the rejecting one. ``labelled`` has ``line`` and a boolean ``accepted``."""
    places = _places(labelled.where(F.length(line) > ORDER).select(F.col(line).alias("line"), "accepted"))
    yes, no = F.col("accepted").cast("long"), (~F.col("accepted")).cast("long")
    tables, lower = [], None
    for k in range(ORDER + 1):
        counts = places.groupBy(F.col(f"g{k}").alias("gram")).agg(F.sum(yes).alias("a"), F.sum(no).alias("r"))
        context = Window.partitionBy(F.substring("gram", 1, k))
        known = counts.select(
            "gram", "a", "r", *(F.sum(c).over(context).alias(f"n{c}") for c in "ar"),
            *(F.sum((F.col(c) > 0).cast("long")).over(context).alias(f"t{c}") for c in "ar"),
            F.substring("gram", 2, k).alias("shorter"),
        )
        if lower is None:
            known = known.withColumn("la", F.lit(1.0 / ALPHABET)).withColumn("lr", F.lit(1.0 / ALPHABET))
        else:
            known = known.join(lower.select(F.col("gram").alias("shorter"), F.col("pa").alias("la"), F.col("pr").alias("lr")), "shorter")

        def smooth(c: str) -> Column:  # Witten-Bell; a context this model never saw adds nothing
            p = (F.col(c) + F.col(f"t{c}") * F.col(f"l{c}")) / (F.col(f"n{c}") + F.col(f"t{c}"))
            return F.when(F.col(f"n{c}") > 0, p).otherwise(F.col(f"l{c}"))

        lower = stage(
            known.select("gram", smooth("a").alias("pa"), smooth("r").alias("pr")),
            f"url-model-{k}",
        )
        tables.append(lower.select(F.col("gram").alias(f"g{k}"), (F.log("pa") - F.log("pr")).alias(f"d{k}")))
    return tables


def score(lines: DataFrame, tables: list[DataFrame], key: list[str], out: str = "score") -> DataFrame:
    """``key`` and the mean log ratio over the characters of ``line``; each character takes the
    longest gram that the models know, 0 if none. Lines without characters are left out."""
    places = _places(lines.where(F.length("line") > ORDER))
    longest = f"g{ORDER}"
    # a place's ratio depends on its longest gram alone: each gram is looked up once, however frequent
    looked = places.groupBy(longest).agg(F.count(F.lit(1)).alias("n"))
    for k, table in enumerate(tables):
        looked = looked.withColumn(f"g{k}", F.substring(longest, ORDER + 1 - k, k + 1)).join(table, f"g{k}", "left")
    best = F.coalesce(*(F.col(f"d{k}") for k in range(ORDER, -1, -1)), F.lit(0.0))
    ratios = stage(looked.select(longest, "n", best.alias("ratio")), "url-ratios")
    frequent = ratios.orderBy(F.desc("n"), longest).limit(BROADCAST_GRAMS).select(longest, F.col("ratio").alias("known"))
    places = places.select(*key, longest).join(F.broadcast(frequent), longest, "left")

    def summed(part: DataFrame, ratio: str) -> DataFrame:
        return part.groupBy(*key).agg(F.sum(ratio).alias("s"), F.count(F.lit(1)).alias("c"))

    sums = summed(places.where("known IS NOT NULL"), "known")
    if ratios.count() > BROADCAST_GRAMS:
        rest = places.where("known IS NULL").join(ratios, longest)
        sums = sums.unionByName(summed(rest, "ratio")).groupBy(*key).agg(F.sum("s").alias("s"), F.sum("c").alias("c"))
    return sums.select(*key, (F.col("s") / F.col("c")).alias(out))


def calibrate(scored: DataFrame) -> float:
    """The threshold with the largest sum of the shares of accepted URLs at or above it and of
    rejected ones below it, halfway to the next lower score; 0 without both kinds.
    ``scored`` has ``score``, ``accepted``, of any number of URLs: counts below a score are those of
    the lower cells (one row for each, bounded by the scores' range) and those within its cell."""
    steps = scored.where("score IS NOT NULL").groupBy("score").agg(F.sum(F.col("accepted").cast("long")).alias("a"), F.count(F.lit(1)).alias("n"))
    steps = stage(steps.withColumn("r", F.col("n") - F.col("a")).withColumn("cell", F.floor(F.col("score") * CELLS)), "url-steps")
    lower = Window.orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)
    all_cells = Window.partitionBy()
    cells = (
        steps.groupBy("cell").agg(F.sum("a").alias("a"), F.sum("r").alias("r"), F.max("score").alias("top"))
        .select(
            "cell", *(F.coalesce(F.sum(c).over(lower), F.lit(0)).alias(f"{c}_below") for c in "ar"),
            F.max("top").over(lower).alias("before"), F.sum("a").over(all_cells).alias("yes"), F.sum("r").over(all_cells).alias("no"),
        ).where("yes > 0 AND no > 0")
    )
    within = Window.partitionBy("cell").orderBy("score")
    below = within.rowsBetween(Window.unboundedPreceding, -1)
    lost, cut = (F.col(f"{c}_below") + F.coalesce(F.sum(c).over(below), F.lit(0)) for c in "ar")
    before = F.coalesce(F.lag("score").over(within), F.col("before"), F.col("score"))
    best = (
        steps.join(cells, "cell")
        .select(((F.col("score") + before) / 2).alias("score"), (cut / F.col("no") - lost / F.col("yes")).alias("gain"))
        .orderBy(F.desc("gain"), "score").limit(1).collect()
    )
    return best[0]["score"] if best else 0.0


def judge(pages: DataFrame, rules: list[Rule], key: str = "page_id", url: str = "url") -> DataFrame:
    """``pages`` reduced to ``key`` and ``url`` plus ``host``, ``path``, ``rule``, ``verdict``
    (the rule's, else the models') and ``score`` (null where a rule decides or there is no text).

    The models learn from all distinct rule-decided URLs, and the threshold is set by all of them,
    each scored by models that did not learn from its fold.
    URLs are scored once however often they occur. A null or empty URL has no evidence against it:
    score null, verdict allow. Without rule-decided URLs of both kinds the threshold is 0."""
    ruled = with_rule(with_host_and_path(pages.select(F.col(key), F.col(url).alias("url"))), rules)
    labelled = ruled.where("rule IS NOT NULL").select(_line("url").alias("line"), (F.col("rule_verdict") == "allow").alias("accepted"))
    labelled = stage(labelled.distinct().withColumn("id", F.monotonically_increasing_id()), "url-labelled")
    tables = train(labelled)
    fold = F.pmod(F.xxhash64("line", F.lit(1)), F.lit(FOLDS))
    told = [score(labelled.where(fold == k), train(labelled.where(fold != k)), ["id", "accepted"]) for k in range(FOLDS)]
    threshold = calibrate(reduce(DataFrame.unionAll, told))
    open_urls = stage(ruled.where("rule IS NULL AND url IS NOT NULL").select("url").distinct().withColumn("line", _line("url")), "url-open")
    scored = score(open_urls, tables, ["url"])
    verdict = F.coalesce("rule_verdict", F.when(F.col("score") < threshold, "block").otherwise("allow"))
    return ruled.join(scored, "url", "left").select(
        key, "url", "host", "path", "rule", verdict.alias("verdict"),
        F.when(F.col("rule").isNull(), F.col("score")).alias("score"),
    )

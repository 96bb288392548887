"""URL filter: block and allow rules first, else a ratio of two character language models.

One variable-order Markov model is counted over the URLs that a rule allows and one over those that
a rule blocks: contexts of two, one and no characters, blended by Witten-Bell weights down to the
uniform distribution, so an unseen context backs off to the next shorter one. A URL's score is the
difference of its log-likelihoods divided by its length; the threshold is the one that separates a
fold of rule-judged URLs, kept out of the counts, with the best balanced accuracy.

URLs are folded to 40 symbols (letters, one digit, eleven signs, any other, the border), so the
table of log-ratios has 40^3 rows whatever the input and is broadcast. DataFrame functions only;
each distinct URL is scored once.

Defined results: null or no ``://`` gives empty host and path; such URLs are judged by the model
(a null URL scores as an empty one); without rule-judged URLs of either kind all scores are 0 and
the verdict is allow; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lapidar.llm.common import written

# Fixed values: (verdict, host, path) of the contract's rules.
RULES = (
    ("block", "net", "/"),
    ("allow", "example.net", "/en/"),
    ("block", "example.com", "/de/"),
    ("allow", "org", "/fr/"),
)
SIGNS = "-._/:?=&#%+"
ALPHABET = "^abcdefghijklmnopqrstuvwxyz0" + SIGNS + "~"  # ^ is the border, 0 any digit, ~ any other
N = len(ALPHABET)
FOLDS = 5
MILLION, BIN = 1_000_000, 1000  # scores are millionths, counted in bins of a thousand
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_of(url: Column) -> Column:
    return F.translate(F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit("")), UPPER, LOWER)


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_of(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """The longest rule that fits, as host and path in one string, and its verdict; null if none fits."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for says, h, p in sorted(rules, key=lambda r: len(r[1] + r[2])):
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        rule, verdict = F.when(fits, h + p).otherwise(rule), F.when(fits, says).otherwise(verdict)
    return rule, verdict


def symbols(url: Column) -> Column:
    """Positions in the alphabet of the URL's characters, with two borders before and one after."""
    folded = F.translate(F.coalesce(url, F.lit("")), UPPER + "123456789", LOWER + "000000000")
    folded = F.regexp_replace(folded, f"[^a-z0{''.join(chr(92) + s for s in SIGNS)}]", "~")
    places = F.transform(
        F.filter(F.split(folded, ""), lambda s: s != ""), lambda s: F.instr(F.lit(ALPHABET), s) - 1
    )
    return F.concat(F.array(F.lit(0), F.lit(0)), places, F.array(F.lit(0)))


def grams(codes: Column) -> Column:
    """Number of each run of three symbols, in order."""
    at = lambda i: F.get(codes, i)
    return F.transform(F.sequence(F.lit(2), F.size(codes) - 1), lambda i: (at(i - 2) * N + at(i - 1)) * N + at(i))


def log_ratios(counts: DataFrame) -> DataFrame:
    """gram, ratio: ln P(allowed) - ln P(blocked) of every run of three symbols, in whole millionths.

    ``counts``: gram, allowed, blocked.
    """
    grid = counts.sparkSession.range(N**3).withColumnRenamed("id", "gram").join(counts, "gram", "left")
    first, middle, last = F.floor(F.col("gram") / N**2), F.pmod(F.floor(F.col("gram") / N), F.lit(N)), F.pmod("gram", F.lit(N))
    rows = grid.select(
        "gram",
        first.alias("a"),
        middle.alias("b"),
        last.alias("c"),
        *(F.coalesce(k, F.lit(0)).alias(k) for k in ("allowed", "blocked")),
    )
    over = lambda x, *by: F.sum(x).over(Window.partitionBy(*by))
    for k in ("allowed", "blocked"):
        seen = lambda x: (F.col(x) > 0).cast("double")
        rows = rows.withColumns({"n2": over(k, "b", "c"), "n1": over(k, "c"), "all": over(k)})
        rows = rows.withColumns(
            {
                "t3": over(seen(k), "a", "b"),
                "s3": over(k, "a", "b"),
                "t2": over(seen("n2"), "b") / N,
                "s2": over(k, "b"),
                "t1": over(seen("n1")) / N**2,
            }
        )
        p = F.lit(1.0 / N)
        for n, s, t in (("n1", "all", "t1"), ("n2", "s2", "t2"), (k, "s3", "t3")):
            p = F.when(F.col(s) > 0, F.try_divide(F.col(n) + F.col(t) * p, F.col(s) + F.col(t))).otherwise(p)
        rows = rows.withColumn(f"p_{k}", p).drop("n2", "n1", "all", "t3", "s3", "t2", "s2", "t1")
    ratio = (F.ln("p_allowed") - F.ln("p_blocked")) * MILLION
    return rows.select("gram", F.round(ratio).cast("long").alias("ratio"))


def runs_of(urls: DataFrame) -> DataFrame:
    """``urls`` with a row for each run of three symbols. The symbols are a column: a run reads three of them."""
    coded = urls.select("*", symbols(F.col("address")).alias("codes"))
    return coded.select(*urls.columns, F.explode(grams(F.col("codes"))).alias("gram"))


def scores(urls: DataFrame, ratios: DataFrame) -> DataFrame:
    """``urls`` (distinct ``address``, other columns) with total and runs: the log-likelihood difference
    in millionths and the number of symbols. Whole numbers add up alike in any order.

    ``ratios`` has 40^3 rows whatever the input, a bounded broadcast.
    """
    rest = [c for c in urls.columns if c != "address"]
    return (
        runs_of(urls).join(F.broadcast(ratios), "gram")
        .groupBy("address")
        .agg(*(F.first(c).alias(c) for c in rest), F.sum("ratio").alias("total"), F.count("*").alias("runs"))
    )


def threshold(scored: DataFrame) -> DataFrame:
    """One row with ``least``: twice the score, in bins, from which a URL is allowed.

    ``scored``: total, runs, verdict. Scores are counted in bins; the cut with the best balanced accuracy
    wins, in the middle of the gap below its bin, ties to the one nearest to 0. 0 where either verdict
    is missing.
    """
    bins = scored.groupBy(F.floor(F.col("total") / (F.col("runs") * BIN)).alias("bin")).agg(
        F.count_if(F.col("verdict") == "allow").alias("allowed"), F.count_if(F.col("verdict") == "block").alias("blocked")
    )
    below = Window.orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)
    total = Window.partitionBy()
    share = lambda k: F.try_divide(F.coalesce(F.sum(k).over(below), F.lit(0)), F.sum(k).over(total))
    lower = F.coalesce(F.lag("bin").over(Window.orderBy("bin")) + 1, F.col("bin"))
    best = bins.select((F.col("bin") + lower).alias("cut"), (1 - share("allowed") + share("blocked")).alias("rate"))
    pick = F.max(F.struct("rate", (-F.abs("cut")).alias("near"), "cut"))
    return best.where("rate IS NOT NULL").agg(F.coalesce(pick["cut"], F.lit(0)).alias("least"))


def url_verdicts(spark: SparkSession, pages: DataFrame, rules=RULES) -> DataFrame:
    """page_id, url, host, path, rule, score and verdict of every row."""
    judged = pages.select("page_id", "url", F.coalesce("url", F.lit("")).alias("address"))
    judged = judged.withColumns({"host": host_of(F.col("url")), "path": path_of(F.col("url"))})
    rule, says = rule_of(F.col("host"), F.col("path"), rules)
    judged = judged.withColumns({"rule": rule, "says": says})
    # a rule's verdict depends on the address alone: the models see each address once
    urls = written(judged.groupBy("address").agg(F.first("says").alias("says")), "urls")
    # few bytes, much work for each: not coalesced by size, and already dealt for the sum by address
    urls = urls.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "address")
    kept_out = F.pmod(F.conv(F.substring(F.md5("address"), 1, 8), 16, 10).cast("long"), F.lit(FOLDS)) == 0
    counts = (
        runs_of(urls.where(F.col("says").isNotNull() & ~kept_out))
        .groupBy("gram")
        .agg(F.count_if(F.col("says") == "allow").alias("allowed"), F.count_if(F.col("says") == "block").alias("blocked"))
    )
    scored = written(scores(urls, written(log_ratios(counts), "url-model")), "url-scores")
    cut = threshold(scored.where(F.col("says").isNotNull() & kept_out).withColumnRenamed("says", "verdict"))
    least = written(cut, "url-cut").scalar() * BIN
    model_says = F.when(F.col("total") * 2 >= least * F.col("runs"), "allow").otherwise("block")
    score = F.col("total") / F.col("runs") / MILLION
    return judged.join(scored.select("address", "total", "runs"), "address").select(
        "page_id", "url", "host", "path", "rule", score.alias("score"), F.coalesce("says", model_says).alias("verdict")
    )

"""URL filters: rules first, then the ratio of two character models. DataFrame functions only.

URLs that a rule allows and URLs that a rule blocks train one variable-order Markov model each. The
probability of a character after its context backs off from ORDER characters to none:
P_k = (count + BACK * P_(k-1)) / (context count + BACK), and P_(-1) is uniform over the characters seen
and one more. A context is extended by a further character only where the longer one occurs at least
SUPPORT times in the model's own URLs; else P_k = P_(k-1). Characters are not folded (a host's A-Z are
lower-cased), so contexts are as many as the URLs give: the table of log ratios grows with the input,
is kept in the shared folder and joined by a shuffle. Grams that hold more than 1/HOT of all characters
(fewer than HOT grams, whatever the data) are salted.

A URL's score is the mean log ratio over its characters, and the threshold is the score that separates
best the rule-decided URLs kept out of training.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tramline.llm.common import partitions, stored

RULES = (  # verdict, host, path
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
)
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
START = "\x02"  # stands before the first character
ORDER = 5  # longest context
SUPPORT = 4  # occurrences that let a context be extended
BACK = 1.0
HOT = 64
FOLDS = 5  # one in FOLDS rule-decided URLs calibrates the threshold and doesn't train
BIN = 0.01


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path; both empty for null or without ``://``."""
    has = F.instr(url, "://") > 0
    rest = F.substring(url, F.instr(url, "://") + 3, F.length(url))
    host = F.regexp_extract(rest, r"^[^/?#]*", 0)
    path = F.regexp_extract(F.regexp_replace(rest, r"^[^/?#]*", ""), r"^[^?#]*", 0)
    return (F.when(has, F.translate(host, UPPER, LOWER)).otherwise(""), F.when(has, path).otherwise(""))


def by_rules(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """Rule (host and path as one string) and verdict of the longest rule that fits; null if none does."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for what, h, p in sorted(rules, key=lambda r: len(r[1] + r[2])):  # the longest is asked first
        fits = ((host == h) | F.endswith(host, F.lit("." + h))) & F.startswith(path, F.lit(p))
        rule, verdict = F.when(fits, h + p).otherwise(rule), F.when(fits, what).otherwise(verdict)
    return rule, verdict


def grams(url: Column) -> Column:
    """Each character of the URL with the ORDER before it, START where there are none; a host's A-Z are lower-cased.

    One pass of a regular expression with a look-ahead, so a very long URL costs no more per character. Nothing for null.
    """
    host_end = F.length(F.regexp_extract(url, r"^(?s).*?://[^/?#]*", 0))
    text = F.concat(F.translate(F.substring(url, F.lit(1), host_end), UPPER, LOWER), F.substring(url, host_end + 1, F.length(url)))
    return F.regexp_extract_all(F.concat(F.lit(START * ORDER), text), F.lit(rf"(?s)(?=(.{{{ORDER + 1}}}))."), F.lit(1))


def log_ratios(counts: DataFrame) -> DataFrame:
    """gram, ratio: log P(accepted) - log P(rejected) of the last character after the others, for every gram counted.

    ``counts``: gram of ORDER + 1 characters, good, bad (how often in accepted and rejected URLs). Each order's counts are sums
    over the longer grams that end alike, and its probabilities join those of the order below by the gram without its first
    character. A join key or window holds at most one row per character of the alphabet.
    """
    lower = None
    for order in range(ORDER + 1):
        level = counts.groupBy(F.substring("gram", -order - 1, order + 1).alias("gram")).agg(F.sum("good").alias("good"), F.sum("bad").alias("bad"))
        context = W.partitionBy(F.substring("gram", 1, order))
        level = level.select("*", F.sum("good").over(context).alias("good_context"), F.sum("bad").over(context).alias("bad_context"),
                             F.count(F.lit(1)).over(context).alias("characters"))
        if lower is None:
            uniform = 1.0 / (F.col("characters") + 1)
            level = level.select("*", uniform.alias("good_below"), uniform.alias("bad_below"))
        else:
            level = (level.withColumn("ending", F.substring("gram", 2, order))
                     .join(lower.select(F.col("gram").alias("ending"), F.col("good_p").alias("good_below"), F.col("bad_p").alias("bad_below")), "ending"))

        def model(n: str, order: int = order) -> Column:
            p = (F.col(n) + BACK * F.col(f"{n}_below")) / (F.col(f"{n}_context") + BACK)
            return F.when(F.col(f"{n}_context") >= SUPPORT, p).otherwise(F.col(f"{n}_below")) if order else p

        lower = level.select("gram", model("good").alias("good_p"), model("bad").alias("bad_p"))
    return lower.select("gram", (F.log("good_p") - F.log("bad_p")).cast("decimal(20,12)").alias("ratio"))


def mean_ratios(urls: DataFrame, counts: DataFrame) -> DataFrame:
    """row, score: mean log ratio of the characters of ``urls`` (row, url); no row without characters. ``counts`` also has times."""
    most = partitions(urls.sparkSession)
    share = F.col("times") / counts.agg(F.sum("times")).scalar()
    hot = F.broadcast(counts.where(share > 1.0 / HOT).select("gram", F.greatest(F.lit(2), F.ceil(share * most)).cast("int").alias("salts")))  # < HOT rows
    salts = F.coalesce("salts", F.lit(1))
    here = (urls.select("row", F.explode(grams(F.col("url"))).alias("gram")).join(hot, "gram", "left")
            .select("row", "gram", F.pmod(F.xxhash64("row"), salts.cast("long")).cast("int").alias("salt")))
    table = log_ratios(counts).join(hot, "gram", "left").select("gram", "ratio", F.explode(F.sequence(F.lit(0), salts - 1)).alias("salt"))
    return (here.join(table, ["gram", "salt"]).groupBy("row")
            .agg((F.sum("ratio").cast("double") / F.count(F.lit(1))).alias("score")))  # decimals: the same sum in any order


def url_verdicts(pages: DataFrame, rules=RULES, id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """``id_col``, host, path, rule, verdict, score of every row.

    A rule's verdict stands. Other URLs are allowed if their score reaches the threshold. A null or
    empty URL has no score and is blocked, as there is nothing to fetch. If rules decide no accepted
    or no rejected URL there is nothing to separate, and undecided URLs are allowed. Ids may be null
    or repeat: each row is judged for itself, equal URLs alike. A very long URL is read whole. Other
    columns are not read. An empty table gives no rows.
    """
    named = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url"))
    host, path = host_and_path(F.col("url"))
    base = named.select("page_id", "url", host.alias("host"), path.alias("path"))
    rule, ruled = by_rules(F.col("host"), F.col("path"), rules)
    fold = F.pmod(F.crc32(F.coalesce("url", F.lit("")).cast("binary")), F.lit(FOLDS))
    base = stored(base.select("page_id", "url", "host", "path", rule.alias("rule"), ruled.alias("ruled"), (fold == 0).alias("calibrates"),
                              F.monotonically_increasing_id().alias("row")), "urls")  # stored: a row keeps its number whoever is lost
    trains = ~F.col("calibrates")
    counts = stored(base.select("ruled", "calibrates", F.explode(grams(F.col("url"))).alias("gram")).groupBy("gram").agg(
        F.count(F.when((F.col("ruled") == "allow") & trains, 1)).alias("good"),
        F.count(F.when((F.col("ruled") == "block") & trains, 1)).alias("bad"), F.count(F.lit(1)).alias("times")), "url-grams")
    scores = stored(mean_ratios(base.select("row", "url"), counts), "url-scores")
    scored = base.join(scores, "row", "left")
    bins = (scored.where("calibrates and ruled is not null and score is not null")
            .groupBy(F.floor(F.col("score") / BIN).alias("bin"))
            .agg(F.count(F.when(F.col("ruled") == "allow", 1)).alias("good"), F.count(F.when(F.col("ruled") == "block", 1)).alias("bad")))
    below = W.orderBy("bin").rowsBetween(W.unboundedPreceding, -1)  # as many bins as scores differ by, some thousands at most
    every = W.orderBy("bin").rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    part = lambda n: F.coalesce(F.sum(n).over(below), F.lit(0)) / F.greatest(F.sum(n).over(every), F.lit(1))
    cut = (bins.select("bin", (part("bad") - part("good")).alias("gain"), F.sum("good").over(every).alias("g"), F.sum("bad").over(every).alias("b"))
           .where("g > 0 and b > 0").agg(F.max_by(F.col("bin") * BIN, F.struct("gain", "bin")).alias("threshold")))
    judged = scored.crossJoin(F.broadcast(cut))  # one row
    verdict = (F.when(F.col("ruled").isNotNull(), F.col("ruled")).when(F.col("score").isNull(), "block")
               .when(F.col("score") >= F.coalesce("threshold", F.lit(float("-inf"))), "allow").otherwise("block"))
    return judged.select(F.col("page_id").alias(id_col), "host", "path", "rule", verdict.alias("verdict"), "score")

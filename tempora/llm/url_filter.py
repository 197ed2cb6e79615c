"""URL filters: host and path rules, and a logistic regression on hashed character n-grams.

DataFrame and Spark ML (JVM) only. Host: after the first `://` up to `/`, `?`, `#` or the end, A-Z
lower-cased; path: then up to `?`, `#` or the end. A rule `host/path` fits its host and all
subdomains if the url's path starts with the rule's path; the longest rule wins. Where none fits,
the model decides: n-grams of three to five characters of host and path, hashed, weighed by a
logistic regression that is trained on a small table of labelled urls.

Defined results: null urls and urls without `://` have empty host and path, which no rule fits and
the model allows; repeated rows each give a row; an empty table gives no rows; other columns are
not read; a probability of exactly one half blocks.
"""

from __future__ import annotations

import re

from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.feature import HashingTF
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

BUCKETS = 1 << 14
#: The rules of the registered query.
RULES = [("com/", "allow"), ("example.com/en/", "block"), ("www.example.com/en/", "allow"), ("net/es/", "block"), ("net/fr/", "block")]
#: Words of unwanted and of wanted urls, in hosts and in paths.
BAD_WORDS = "casino poker slots slot roulette jackpot blackjack gambling gamble betting bets bet24 sportsbet bookmaker lottery bingo bonus porn xxx sex sexchat adult cams nude escort erotic viagra cialis pills pharma steroids payday loan loans cash-advance free-money free-bets win-prize winner crypto-doubler replica replicas watches-cheap counterfeit warez crack keygen torrent pirate malware phish verify-account spam spamhub linkfarm backlinks popunder adserver ads-track track-click click-farm clicks-ads track-pixel giveaway cheap-pills cheap-watches".split()
GOOD_WORDS = "news daily library museum university weather gardening recipes history science mathematics physics council hospital railway airport theatre concert orchestra school teacher students research journal letters archive maps travel mountains rivers birds botany cooking bakery books reading writer poetry language grammar thornton thereon thatcher tinned erhard inning stand heather oration ethane report article about contact blog post index page story culture music film sport football tennis chess economy politics election health medicine garden forest water energy climate village city street house family children history-of guide lesson course lecture paper study review forum help privacy terms sussex essex scunthorpe trackside adsorption address slottery betty better between pillar pillow wincing click-here cracker escorted".split()
#: Patterns of hosts and paths; a and b stand for words, n for a number.
HOSTS = "a.example.com a-b.example.net ab.example.org www.a.example.com m.a.example.net blog.a-b.example.org a-n.example.com my-a.example.net b.a.example.com".split()
PATHS = "/a /a/ /en/a/b /de/a.html /a-b/n /blog/2020/a /b/a/n /a_b.html /es/b-a/ /fr/n/a".split()
NEUTRAL_PATHS = "/en/n /de/n.html /fr/n/ /es/n / /index.html /en/ /p/n/n /x/y/n".split()
SYLLABLES = "an er th in on re st en ti nd ed ha le or es be ou ar ch ge ie un ei de la el io co pa ra".split()
#: Rows of the labelled table; three in ten have an unwanted host, three in ten an unwanted path.
LABELLED_ROWS = 12_000


def host_of(url: Column) -> Column:
    rest = F.substring(url, F.instr(url, "://") + F.lit(3), F.length(url))
    host = F.regexp_extract(rest, r"^([^/?#]*)", 1)
    return F.when(F.instr(url, "://") > 0, F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")).otherwise("")


def path_of(url: Column) -> Column:
    rest = F.substring(url, F.instr(url, "://") + F.lit(3), F.length(url))
    return F.when(F.instr(url, "://") > 0, F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)).otherwise("")


def rule_for(host: Column, path: Column, rules: list[tuple[str, str]] = RULES) -> Column:
    """struct(rule, verdict) of the longest rule that fits, else null."""
    choice = F.lit(None).cast("struct<rule:string,verdict:string>")
    for rule, verdict in sorted(rules, key=lambda r: len(r[0])):  # the last that fits is the longest
        rule_host, _, rest = rule.partition("/")
        fits = ((host == rule_host) | host.endswith("." + rule_host)) & path.startswith("/" + rest)
        choice = F.when(fits, F.struct(F.lit(rule).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(choice)
    return choice


def _windows(part: str, col: Column, n: int) -> Column:
    at = F.when(F.length(col) >= n, F.sequence(F.lit(1), F.length(col) - (n - 1))).otherwise(F.array().cast("array<int>"))
    return F.transform(at, lambda i: F.concat(F.lit(part), F.substring(col, i, F.lit(n))))


def grams(host: Column, path: Column) -> Column:
    """Character n-grams of three to five of host and path, each with its ends marked and its part told."""
    marked = (("h", F.concat(F.lit("^"), host, F.lit("$"))), ("p", F.concat(F.lit("^"), path, F.lit("$"))))
    return F.concat(*(_windows(part, col, n) for part, col in marked for n in (3, 4, 5)))


def labelled(spark: SparkSession, seed: int = 0, rows: int = LABELLED_ROWS) -> DataFrame:
    """host, path, label: urls built by rule from the words and patterns; an unwanted host or path is unwanted.

    The words are in any place of a host or path, alone or joined, next to wanted words, numbers and
    made-up words, so that neither part tells the label of the other.
    """
    draw = lambda k, n: F.pmod(F.xxhash64("id", F.lit(seed * 100 + k)), F.lit(n)).cast("int")
    pick = lambda k, xs: F.element_at(F.array(*map(F.lit, xs)), draw(k, len(xs)) + 1)
    made_up = lambda k: F.concat(*(pick(k + j, SYLLABLES) for j in range(3)))

    def part(k: int, bad: Column, patterns: list[str]) -> Column:
        good = F.when(draw(k, 3) == 0, made_up(k + 1)).otherwise(pick(k + 4, GOOD_WORDS))
        one = F.when(bad, pick(k + 5, BAD_WORDS)).otherwise(good)
        two = F.when(draw(k + 6, 2) == 0, made_up(k + 7)).otherwise(pick(k + 10, GOOD_WORDS))
        number = draw(k + 11, 1000).cast("string")
        text = pick(k + 12, [re.sub(r"\b(a|ab|b|n)(?![a-z])|(?<=_)b", lambda m: {"a": "<A>", "b": "<B>", "ab": "<A><B>", "n": "<N>"}[m[0]], x) for x in patterns])
        for mark, value in (("<A>", one), ("<B>", two), ("<N>", number)):
            text = F.replace(text, F.lit(mark), value)
        return text

    bad_host, bad_path = draw(1, 10) < 3, draw(2, 10) < 3
    path = F.when(~bad_path & (draw(3, 2) == 0), part(40, F.lit(False), NEUTRAL_PATHS)).otherwise(part(60, bad_path, PATHS))
    return spark.range(0, rows, 1, 1).select(part(20, bad_host, HOSTS).alias("host"), path.alias("path"), (bad_host | bad_path).cast("double").alias("label"))


def train(table: DataFrame, buckets: int = BUCKETS) -> LogisticRegressionModel:
    data = HashingTF(inputCol="grams", outputCol="features", numFeatures=buckets).transform(table.select("label", grams(F.col("host"), F.col("path")).alias("grams")))
    return LogisticRegression(regParam=0.001, maxIter=40).fit(data)


def judge(pages: DataFrame, model: LogisticRegressionModel, id_col: str = "page_id", url_col: str = "url", rules: list[tuple[str, str]] = RULES) -> DataFrame:
    """id, host, path, rule, verdict, p_block for every row."""
    rows = pages.select(F.col(id_col).alias("id"), F.coalesce(host_of(F.col(url_col)), F.lit("")).alias("host"), F.coalesce(path_of(F.col(url_col)), F.lit("")).alias("path"))
    rows = rows.withColumn("grams", grams(F.col("host"), F.col("path")))
    from pyspark.ml.functions import vector_to_array

    scored = model.transform(HashingTF(inputCol="grams", outputCol="features", numFeatures=model.numFeatures).transform(rows))
    p = F.when((F.col("host") == "") & (F.col("path") == ""), 0.0).otherwise(F.element_at(vector_to_array("probability"), 2))
    scored = scored.select("id", "host", "path", rule_for(F.col("host"), F.col("path"), rules).alias("r"), p.alias("p_block"))
    return scored.select(F.col("id").alias(id_col), "host", "path", F.col("r.rule").alias("rule"), F.coalesce("r.verdict", F.when(F.col("p_block") >= 0.5, "block").otherwise("allow")).alias("verdict"), "p_block")

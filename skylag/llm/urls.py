"""Judge URLs by rules and by a logistic regression on hashed character n-grams.

The host of a URL is what follows the first ``://`` up to ``/``, ``?``, ``#`` or the
end, with A to Z lower-cased; the path goes on from there up to ``?``, ``#`` or the
end. NULL and URLs without ``://`` have an empty host and path.

A rule is a host and the begin of a path, written together (``example.org/es/``). It
fits its host and all subdomains whose path begins so; of several the longest wins,
of equally long ones the first in alphabetical order. Where no rule fits, the model
decides: its features are the distinct runs of three, four and five characters of the
host and of the path, each hashed to one of ``DIMENSIONS`` places; the weights come
from a small table of labelled URLs, which alone is read for training: written-out ones,
and names of both kinds put into the same shapes of URL, so that subdomains, domains,
paths and queries tell nothing and the words of the host decide. All of
it is plain column work: no shuffle, no Python in tasks.

Defined results: a URL without features is judged by the model's intercept; repeated
rows are judged each; empty tables give empty tables; other columns stay, but those
named like an added one are replaced.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import CountVectorizerModel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# About as many as the labelled table has distinct runs; with a quarter, chance decided too often.
DIMENSIONS = 1 << 14
SIZES = (3, 4, 5)

# A small labelled table of made-up URLs, 1 to block and 0 to allow.
BLOCKED_URLS = """
http://casino-bonus.example.biz/free-spins/win
http://www.online-casino.example.com/poker/jackpot
https://best-slots.example.net/casino/register?ref=1
http://poker-king.example.com/bonus/deposit
http://budget-pills.example.biz/viagra/order
https://pharmacy-discount.example.info/cialis/buy-now
http://rx-meds.example.com/pills/no-prescription
https://adult-cams.example.net/xxx/live
http://xxx-videos.example.com/porn/free
http://hot-singles.example.biz/dating/xxx
https://porn-tube.example.info/adult/videos
http://free-gift.example.biz/win/prize/claim
https://prize-winner.example.com/claim/reward
http://lottery-win.example.net/jackpot/claim-now
https://click-track.example.com/ads/click?id=7
http://adserver.example.net/banner/popup.js
https://tracker.example.biz/pixel/click
http://popup-ads.example.com/adclick/redirect
https://loan-fast.example.biz/payday/apply-now
http://payday-loans.example.com/credit/instant
https://crypto-double.example.net/giveaway/bitcoin
http://bitcoin-giveaway.example.biz/double/claim
https://replica-watches.example.com/cheap/rolex
http://rolex-replica.example.net/buy/cheap
https://login-verify.example.biz/secure/account/update-password
http://paypa1-secure.example.com/verify/login.php
https://bank-verify.example.net/account/confirm-password
http://download-crack.example.biz/keygen/serial
https://warez-crack.example.com/torrent/full-version
http://keygen-free.example.net/crack/download.exe
https://seo-links.example.biz/backlinks/buy
http://buy-followers.example.com/likes/cheap
""".split()
ALLOWED_URLS = """
https://news.example.com/en/1042/
https://www.example.org/en/25817
https://blog.example.net/2021/05/reading-notes.html
https://docs.example.org/en/latest/guide.html
https://wiki.example.org/wiki/History
https://library.example.edu/catalogue/item/881
https://science.example.edu/research/papers/12
https://city.example.gov/services/water
https://weather.example.gov/forecast/today
https://m.example.com/fr/38410?page=2
https://www.example.net/de/17494
https://shop.example.com/books/fiction/104
https://recipes.example.net/soup/onion.html
https://forum.example.org/thread/5512
https://example.net/es/36134/
https://blog.example.com/en/26111/
http://example.net/en/30619
https://museum.example.org/exhibits/2020
https://school.example.edu/courses/math
https://travel.example.com/guides/alps
https://health.example.gov/advice/flu
https://music.example.net/albums/review/77
https://garden.example.org/plants/roses
https://sports.example.com/results/season
https://the.example.net/en/31536.html
https://other.example.com/de/49143
https://code.example.org/project/readme
https://data.example.gov/tables/census
https://radio.example.net/programme/morning
https://www.journal.example.com/articles/9310.html
https://film.example.org/reviews/drama
https://maps.example.com/fr/34697
""".split()

# Words of hosts by theme. Neighbours in a row make a name, as the last
# and first do.
BLOCKED_WORDS = """
casino bonus poker slots bets jackpot roulette wager lottery spins betting
pills pharmacy viagra rx meds cialis discount
adult cams xxx porn singles escort sexy
ads click track pixel banner popup adserver tracker
payday loan cash credit crypto giveaway bitcoin double
free prize win claim gift winner cheap replica rolex
crack keygen warez torrent serial
verify login secure account password update
spam links backlinks seo followers likes bulk
spam junk mailer spammer blast scam
""".strip().splitlines()
ALLOWED_WORDS = """
news journal library museum school garden recipes travel
science weather wiki docs books music sports health history
city forum code maps radio film research kitchen
river mountain bridge farm market bakery college gallery
theatre orchard village harbour photo design poetry physics
nature teacher walking cycling studio parish coffee winter
open daily green north family local old little
""".strip().splitlines()
# Names without a meaning are ordinary; they are made of two syllables, taken in turn.
_ONSETS = "b br d dr f g gl h k l m n p pr r s st sh t th tr v w".split()
_ENDINGS = "an el in or us ale ent ith ora est".split()
_PLAIN_NAMES = 230
# Shapes of URL that names of both kinds take in turn; their counts have no common divisor.
_SUBDOMAINS = ("", "www.", "m.", "blog.", "shop.")
_DOMAINS = ("com", "net", "org")
_PATHS = ("en/{n}", "fr/{n}.html", "de/{n}/", "es/{n}?page=2", "en/{n}#top", "index.html", "articles/{n}")


def shaped_urls(names: list[str]) -> list[str]:
    """Three URLs of each name, in shapes that follow from the place in the list alone."""
    out = []
    for number in range(3 * len(names)):
        sub, path = _SUBDOMAINS[number % 5], _PATHS[number % 7].format(n=17 * number + 11)
        out.append(f"https://{sub}{names[number // 3]}.example.{_DOMAINS[number % 3]}/{path}")
    return out


def _neighbours(themes: list[str]) -> list[str]:
    """Names of two neighbouring words of a theme, and of each word alone."""
    rows = [theme.split() for theme in themes]
    pairs = [f"{a}-{b}" for row in rows for a, b in zip(row, [*row[1:], row[0]], strict=True)]
    return pairs + [word for row in rows for word in row]


def _plain_names() -> list[str]:
    """Names of two syllables without a meaning."""
    a, b = len(_ONSETS), len(_ENDINGS)
    return [
        _ONSETS[k % a] + _ENDINGS[k % b] + _ONSETS[(7 * k + 3) % a] + _ENDINGS[(3 * k + 1) % b]
        for k in range(_PLAIN_NAMES)
    ]


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host and path columns of a URL column."""
    mark = F.instr(url, "://")
    rest = F.when(mark > 0, F.substring(url, mark + 3, F.length(url)))
    host = F.regexp_extract(rest, "^[^/?#]*", 0)
    path = F.regexp_extract(F.substring(rest, F.length(host) + 1, F.length(rest)), "^[^?#]*", 0)
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    lowered = F.translate(host, upper, upper.lower())
    return F.coalesce(lowered, F.lit("")), F.coalesce(path, F.lit(""))


def matching_rule(host: Column, path: Column, rules: list[str]) -> Column:
    """The longest rule that fits, or NULL. Rules are a short list given by the user."""
    fits = []
    for rule in sorted(rules, key=lambda r: (-len(r), r)):
        name, slash, begin = rule.partition("/")
        in_host = (host == name) | F.endswith(host, F.lit("." + name))
        fits.append(F.when(in_host & F.startswith(path, F.lit(slash + begin)), F.lit(rule)))
    return F.coalesce(F.lit(None).cast("string"), *fits)


def _grams(value: Column, field: str) -> Column:
    """Places of the distinct character runs of a field, marked by its first letter."""
    # The mark and the closing sign let runs know the field's begin and end.
    letters = F.split(F.concat(F.lit(field), value, F.lit("$")), "")

    def run(size: int) -> Column:
        starts = F.sequence(F.lit(1), F.greatest(F.size(letters) - size + 1, F.lit(1)))
        return F.transform(starts, lambda i: F.concat_ws("", F.slice(letters, i, size)))

    runs = F.concat(*(run(size) for size in SIZES))
    marked = F.transform(
        F.array_distinct(runs), lambda g: F.xxhash64(F.concat(F.lit(field), g))
    )
    return F.transform(marked, lambda h: F.pmod(h, F.lit(DIMENSIONS)).cast("int"))


def places(host: Column, path: Column) -> Column:
    """Hashed features of a URL: one place for each run, as often as runs fall on it."""
    return F.concat(_grams(host, "h"), _grams(path, "p"))


@dataclass(frozen=True)
class UrlModel:
    """Weights of the places and the intercept."""

    weights: tuple[float, ...]
    intercept: float

    def probability(self, features: Column) -> Column:
        """Probability that a URL is to be blocked."""
        # One literal of a fixed number of weights, parsed once when the plan is made.
        table = F.split(F.lit(",".join(map(repr, self.weights))), ",").cast("array<double>")
        total = F.aggregate(
            features, F.lit(self.intercept), lambda a, i: a + F.get(table, i)
        )
        return 1 / (1 + F.exp(-total))


def labelled_urls(spark: SparkSession) -> DataFrame:
    """The small labelled table: url, label."""
    blocked = [*BLOCKED_URLS, *shaped_urls(_neighbours(BLOCKED_WORDS))]
    allowed = [*ALLOWED_URLS, *shaped_urls(_neighbours(ALLOWED_WORDS) + _plain_names())]
    rows = [(u, 1.0) for u in blocked] + [(u, 0.0) for u in allowed]
    return spark.createDataFrame(rows, "url string, label double").coalesce(1)


def train(labelled: DataFrame, strength: float = 0.001, iterations: int = 40) -> UrlModel:
    """Fit the model to a small table (url, label); the same table gives the same model."""
    features = places(*host_and_path(F.col("url"))).cast("array<string>")
    rows = labelled.filter("label IS NOT NULL").select("label", features.alias("places"))
    counted = CountVectorizerModel.from_vocabulary(
        [str(i) for i in range(DIMENSIONS)], inputCol="places", outputCol="features"
    )
    rows = counted.transform(rows).select("label", "features")
    fit = LogisticRegression(
        regParam=strength, maxIter=iterations, standardization=False
    ).fit(rows)
    return UrlModel(tuple(map(float, fit.coefficients.toArray())), float(fit.intercept))


def judge(
    df: DataFrame, model: UrlModel, rules: dict[str, str], url: str = "url", cut: float = 0.5
) -> DataFrame:
    """Add host, path, rule, block_score and verdict; ``rules`` maps rules to verdicts."""
    added = ("host", "path", "rule", "block_score", "verdict")
    host, path = host_and_path(F.col(url))
    kept = [c for c in df.columns if c == url or c.lower() not in added]
    rows = df.select(*kept, host.alias("host"), path.alias("path"))
    rows = rows.withColumn("rule", matching_rule(F.col("host"), F.col("path"), list(rules)))
    score = model.probability(places(F.col("host"), F.col("path")))
    verdicts = [F.when(F.col("rule") == rule, F.lit(v)) for rule, v in rules.items()]
    learned = F.when(F.col("block_score") > cut, F.lit("block")).otherwise(F.lit("allow"))
    return rows.withColumn("block_score", score).withColumn(
        "verdict", F.coalesce(*verdicts, learned)
    )


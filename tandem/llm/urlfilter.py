"""URL filter: host rules first, then logistic regression on hashed character n-grams.

Everything runs as DataFrame expressions and Spark ML on the JVM.
"""

from __future__ import annotations

from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.feature import HashingTF
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: (host, path, verdict); a host without a dot is a top-level domain.
RULES = (("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow"))

# Words of hosts in the small labelled table, and words met in both kinds.
BLOCK_WORDS = (
    "spam", "pills", "casino", "bets", "ads", "adult", "poker", "xxx", "cams", "clicks", "replica", "payday", "slots",
    "jackpot", "seo-links", "viagra", "cialis", "lottery", "prize", "bonus", "gambling", "roulette", "bingo", "porn",
    "escort", "sexy", "hookup", "betting", "win-cash", "cheap-meds", "pharma-sale", "hair-loss", "weight-loss",
    "fake-watches", "quick-loans", "torrent-crack", "warez", "keygen", "popunder", "adserver", "tracker-pixel",
    "spam-farm", "link-farm", "cheap-pills", "casino-win", "free-bets", "ads-track", "win-prize")
ALLOW_WORDS = (
    "library", "university", "museum", "weather", "recipes", "gardening", "science", "council", "history", "open-data",
    "bakery", "railway", "orchestra", "school", "news", "travel", "kitchen", "photography", "theatre", "hospital",
    "football", "chess", "cycling", "astronomy", "physics", "biology", "literature", "poetry", "music", "cinema",
    "archive", "journal", "magazine", "newspaper", "forum", "community", "software", "developer", "engineering", "design",
    "architecture", "furniture", "clothing", "bookshop", "flowers", "coffee", "restaurant", "hotel", "airport", "harbour",
    "mountain", "river", "forest", "nature", "animals", "birds", "garden", "farmers", "market", "insurance",
    "mortgage", "bank", "energy", "water", "transport", "bicycle", "motor", "repair", "plumber", "carpenter",
    "painting", "sculpture", "gallery", "dance", "theology", "church", "charity", "volunteers", "parliament", "government",
    "statistics", "mathematics", "chemistry", "medicine", "dentist", "pharmacy", "nursing", "kindergarten", "family", "parenting",
    "wedding", "holiday", "camping", "hiking", "climbing", "sailing", "fishing", "running", "tennis", "swimming",
    "author", "theory", "method", "youth", "northern", "southern", "mother", "brother", "thread", "therapy",
    "thermal", "theorem", "together", "another", "clothes", "earth", "health", "leather", "feather", "authentic",
    "nation", "station", "education", "information", "tradition", "translation", "vegetable", "sustainable", "hour", "house")
EITHER_WORDS = ("online", "best", "free", "my", "city", "the", "world", "shop", "club", "home", "top", "web", "hub", "net")
SITES = ("www.{}.com", "{}.example.com", "{}.org", "blog.{}.example.org", "m.{}.io", "{}.co.uk", "pages.{}.info", "{}.de")
PATHS = ("/en/728", "/de/articles", "/fr/176", "/", "/es/533.html", "/index", "/2020/10/page", "")
#: The ends of hosts that many owners share.
PUBLIC_SUFFIX = r"\.((co|com|org|net|ac|gov|edu)\.[a-z]{2}|[^.]*)$"


def parsed(rows: DataFrame, url: str = "url") -> DataFrame:
    """``rows`` with host and path (a column of either name is replaced)."""
    rest = F.when(F.instr(F.col(url), "://") > 0, F.col(url).substr(F.instr(F.col(url), "://") + 3, F.length(url)))
    rest = F.coalesce(rest, F.lit(""))
    host = F.regexp_extract(rest, r"^([^/?#]*)", 1)
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return rows.withColumns({"host": F.translate(host, upper, upper.lower()), "path": path})


def rule_column(rules=RULES) -> tuple[Column, Column]:
    """The longest fitting rule (host + path) and its verdict; null if none fits.  Of rules
    of one length the one that comes first in the table wins."""
    text = verdict = F.lit(None).cast("string")
    for host, path, says in sorted(rules, key=lambda r: len(r[0]) + len(r[1]), reverse=True)[::-1]:
        fits = ((F.col("host") == host) | F.col("host").endswith("." + host)) & F.col("path").startswith(path)
        text = F.when(fits, F.lit(host + path)).otherwise(text)
        verdict = F.when(fits, F.lit(says)).otherwise(verdict)
    return text, verdict


def grams(column: Column, tag: str, sizes=(3, 4, 5)) -> Column:
    """The character n-grams of a marked text, each with ``tag`` before it."""
    marked = F.concat(F.lit("^"), column, F.lit("$"))
    parts = [F.when(F.length(marked) >= n, F.transform(
        F.sequence(F.lit(1), F.length(marked) - n + 1), lambda i, n=n: F.concat(F.lit(tag), F.substring(marked, i, F.lit(n)))))
        .otherwise(F.array().cast("array<string>")) for n in sizes]
    return F.concat(*parts)


def gram_column() -> Column:
    """Once each: the n-grams of the host's labels without its public suffix, and those
    of the path without digits.  A label begins and ends alike wherever it stands, so the
    registered name reads the same with and without subdomains before it."""
    own = F.regexp_replace("host", PUBLIC_SUFFIX, "")
    labels = F.replace(own, F.lit("."), F.lit("$^"))
    return F.array_distinct(F.concat(grams(labels, "h:"), grams(F.regexp_replace("path", "[0-9]+", "0"), "p:")))


def labelled_urls(spark: SparkSession) -> DataFrame:
    """The small labelled table: url, label (1: block).  Each word alone, in the
    plural, with a word of either kind, and joined to another of its own kind, at every kind
    of site, so that only the words tell."""
    rows = []
    for words, label in ((BLOCK_WORDS, 1.0), (ALLOW_WORDS, 0.0)):
        for i, word in enumerate(words):
            other, either = words[(i * 7 + 3) % len(words)], EITHER_WORDS[i % len(EITHER_WORDS)]
            for k, name in enumerate((word, f"{either}-{word}", f"{word}{either}", f"{word}-{other}", f"{either}{word}", f"{word}s")):
                rows += [(f"https://{site.format(name)}{PATHS[(i + k + n) % len(PATHS)]}", label) for n, site in enumerate(SITES)]
    return spark.createDataFrame(rows, "url string, label double")


def _hashed(buckets: int) -> HashingTF:
    return HashingTF(inputCol="__grams", outputCol="__x", numFeatures=buckets, binary=True)


def fit(labelled: DataFrame, buckets: int = 1 << 14) -> LogisticRegressionModel:
    rows = _hashed(buckets).transform(parsed(labelled).withColumn("__grams", gram_column()))
    return LogisticRegression(featuresCol="__x", labelCol="label", regParam=0.003, maxIter=40).fit(rows.coalesce(1))


def judged(pages: DataFrame, labelled: DataFrame | None = None, rules=RULES, threshold: float = 0.5,
           buckets: int = 1 << 14, url: str = "url") -> DataFrame:
    """page_id, host, path, rule, verdict and the model's block score of each row.

    A null or odd url has an empty host and path; no rule fits it, and the model judges
    the empty strings.  Urls of any length are read whole.  Repeated rows are judged
    alike, and equal scores too; a score of exactly ``threshold`` blocks.  Columns other
    than page_id and the url are not read; an empty table gives none.
    ``rules`` is a bounded list, written into the plan."""
    spark = pages.sparkSession
    model = fit(labelled if labelled is not None else labelled_urls(spark), buckets)
    rows = parsed(pages.select("page_id", F.col(url).alias("url"))).withColumn("__grams", gram_column())
    scored = model.setFeaturesCol("__x").setProbabilityCol("__p").transform(_hashed(buckets).transform(rows))
    block = vector_to_array("__p")[1]
    rule, says = rule_column(rules)
    by_model = F.when(block >= threshold, "block").otherwise("allow")
    return scored.select("page_id", "host", "path", rule.alias("rule"), F.coalesce(says, by_model).alias("verdict"), block.alias("score"))


def op8(pages: DataFrame) -> DataFrame:
    return judged(pages)

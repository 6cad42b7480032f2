"""URL filters: rules first, then logistic regression on hashed character n-grams of host and path.

All that runs over the urls is built-in SQL: parsing, rules, n-grams, hashing and the weighted sum. The
model is fitted once from a small labelled table (labelled_urls) and reaches the plan as literals.

Host: after the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z in lower case; path: from there up to
``?``, ``#`` or the end. A null url, or one without ``://``, has both empty and is judged by the intercept. A rule
fits its host and its subdomains if the path starts with the rule's; the longest wins (ties: the one that
sorts last). Repeated rows are judged alike; an empty table gives no rows; columns called like an output are
replaced.
"""

from __future__ import annotations

from functools import lru_cache
from string import ascii_lowercase, ascii_uppercase

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gleaner.llm.common import documents, unused

#: Sizes of n-grams, and weights they are hashed to.
SIZES, WEIGHTS = (3, 4, 5), 4096
#: Rules tried in one expression.
RULES_AT_ONCE = 200

#: Fixed values: (verdict, host, path).
RULES = (
    ("block", "com", "/en/"),
    ("allow", "example.com", "/en/7"),
    ("allow", "net", "/de/"),
    ("block", "example.net", "/de/8"),
    ("block", "org", "/es/"),
)

#: Words of hosts and paths that the labelled table is made of.
UNWANTED = (
    "casino poker viagra cheap pills pharmacy spam farm bet betting slots loan loans payday xxx porn adult escort replica "
    "watches lottery jackpot click bait free money crypto giveaway torrent warez crack keygen malware phish win"
).split()
WANTED = (
    "library school museum weather garden recipes history science travel news city council hospital music theatre books "
    "research archive forum journal village kitchen station review photo cinema nature college bakery harbour river"
).split()
PARTS = "th on er and tion ing ber lich gen eau que ion men ado las ure enta old ari".split()


def labelled_urls() -> list[tuple[str, int]]:
    """The labelled table, by rule: each word alone and in pairs, as host or path, and invented names; 1: unwanted."""
    rows = []
    for label, words in ((1, UNWANTED), (0, WANTED)):
        for i, word in enumerate(words):
            top, lang = ("com", "net", "org")[i % 3], ("en", "de", "fr", "es")[i % 4]
            for k, sub in enumerate(("", "www.", "m.", "blog.")):
                other = words[(i * 7 + 3 + 11 * k) % len(words)]
                rows.append((f"http://{sub}{word}-{other}.example.{top}/{lang}/{i * 37 + 211 * k}", label))
            rows += [
                (f"https://{word}{other}.{top}/", label),
                (f"https://www.{word}.example.{top}/{other}/{i * 53 % 997}.html", label),
                (f"https://{PARTS[i % 19]}{PARTS[i * 3 % 17]}.{top}/{word}/page?id={i}", label),
            ]
    for i in range(60):  # invented names
        part = PARTS[i * 5 % 19] + PARTS[i * 11 % 17] + PARTS[i % 13]
        top, lang = ("com", "net", "org")[i % 3], ("en", "de", "fr", "es")[i % 4]
        rows += [
            (f"https://{('m.', 'www.', 'blog.', '')[i % 4]}{part}.example.{top}/{lang}/{i * 41}", 0),
            (f"http://{part}.{top}/{PARTS[i % 19]}{PARTS[i * 3 % 19]}.html", 0),
        ]
    return rows


def host_and_path(url: Column) -> tuple[Column, Column]:
    at = F.locate("://", url)
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url)))
    host = F.translate(F.regexp_extract(rest, "^([^/?#]*)", 1), ascii_uppercase, ascii_lowercase)
    return F.coalesce(host, F.lit("")), F.coalesce(F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_of(host: Column, path: Column, rules: tuple = RULES) -> Column:
    """The longest fitting rule: struct of size, rule and verdict, or null."""
    best = []
    for at in range(0, len(rules), RULES_AT_ONCE):
        some = F.array(
            *(
                F.struct(F.lit(len(h + p)).alias("size"), F.lit(h + p).alias("rule"), F.lit(v).alias("verdict"), F.lit(h).alias("h"), F.lit(p).alias("p"))
                for v, h, p in rules[at : at + RULES_AT_ONCE]
            )
        )
        fits = F.filter(some, lambda r: ((host == r.h) | F.endswith(host, F.concat(F.lit("."), r.h))) & F.startswith(path, r.p))
        best.append(F.array_max(fits))
    return best[0] if len(best) == 1 else F.greatest(*best)


def ngrams(chars: Column, mark: str) -> Column:
    """The n-grams of an array of characters, as an array."""

    def of(n: int) -> Column:
        starts = F.sequence(F.lit(0), F.greatest(F.size(chars) - n, F.lit(0)))
        return F.transform(starts, lambda i: F.concat(F.lit(mark), *(F.coalesce(F.get(chars, i + k), F.lit("")) for k in range(n))))

    return F.when(F.size(chars) > 0, F.concat(*map(of, SIZES))).otherwise(F.array().cast("array<string>"))


def with_buckets(df: DataFrame, name: str) -> DataFrame:
    """Adds the hashed n-grams of host and path, their ends marked; an empty part has none."""
    marked = lambda c: F.when(F.length(c) > 0, F.split(F.concat(F.lit("^"), c, F.lit("$")), "")).otherwise(F.array().cast("array<string>"))
    one, two = unused(df, "_host"), unused(df, "_path")
    chars = df.withColumns({one: marked(F.col("host")), two: marked(F.col("path"))})
    both = F.concat(ngrams(F.col(one), "h"), ngrams(F.col(two), "p"))
    return chars.withColumn(name, F.transform(both, lambda g: F.pmod(F.xxhash64(g), F.lit(WEIGHTS)).cast("int"))).drop(one, two)


@lru_cache(1)
def fit() -> tuple[float, tuple[float, ...]]:
    """Intercept and the weight of each bucket, fitted from the labelled table."""
    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.feature import CountVectorizer

    spark = SparkSession.getActiveSession()
    rows = spark.createDataFrame(labelled_urls(), "url string, label int").coalesce(1)
    host, path = host_and_path(F.col("url"))
    held = with_buckets(rows.select(F.col("label").cast("double").alias("label"), host.alias("host"), path.alias("path")), "buckets")
    terms = held.select("label", F.transform("buckets", lambda b: b.cast("string")).alias("terms")).cache()
    counter = CountVectorizer(inputCol="terms", outputCol="features", vocabSize=WEIGHTS).fit(terms)
    model = LogisticRegression(regParam=0.001, maxIter=80, standardization=False).fit(counter.transform(terms))
    terms.unpersist()
    weights = [0.0] * WEIGHTS
    for bucket, weight in zip(counter.vocabulary, model.coefficients, strict=True):
        weights[int(bucket)] = round(float(weight), 6)
    return float(model.intercept), tuple(weights)


def chance(buckets: str) -> Column:
    """The model's probability that a url with these buckets is unwanted."""
    intercept, weights = fit()
    table = F.array(*(F.lit(w) for w in weights))
    return 1 / (1 + F.exp(-F.aggregate(buckets, F.lit(intercept), lambda a, b: a + F.get(table, b))))


def filter_urls(df: DataFrame, url: str = "url", rules: tuple = RULES, least: float = 0.5) -> DataFrame:
    """Adds host, path, rule, verdict and score (the model's probability, for every url)."""
    host, path = host_and_path(F.col(url))
    held = df.withColumns({"host": host, "path": path})
    buckets, fits = unused(held, "_buckets"), unused(held, "_fits")
    out = with_buckets(held, buckets).withColumns({fits: rule_of(F.col("host"), F.col("path"), rules), "score": chance(buckets)})
    judged = F.coalesce(F.col(fits)["verdict"], F.when(F.col("score") >= least, "block").otherwise("allow"))
    return out.withColumns({"rule": F.col(fits)["rule"], "verdict": judged}).drop(fits, buckets)


def op7_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """page_id, host, path, rule and verdict of every page."""
    judged = filter_urls(documents(spark, sf_dir, "pages").select("page_id", "url"))
    return judged.select("page_id", "host", "path", "rule", "verdict", "score")

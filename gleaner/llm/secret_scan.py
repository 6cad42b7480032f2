"""Secret scans: candidates by pattern, false positives removed by a random forest.

All that runs over the texts is built-in SQL. One regular expression marks candidates (values given to a
key such as ``token =``, and long runs with a digit), the text is split at the marks, and each candidate is
described by its length, character transitions, dictionary coverage, path and neighbouring words. The forest
is trained once from labelled findings (labelled_findings, LABELLED rows made by rule) and reaches the plan as
CASE expressions; a finding is kept if at least half of the trees vote for it.

A control character U+0001 counts as two in the shortest value of six characters, and is kept as it is.

Null texts have no findings and stay null when redacted; empty texts stay empty. Repeated rows are scanned one
by one; an empty table gives no rows. Texts of any length are scanned whole. Columns named like an output are
replaced.
"""

from __future__ import annotations

import random
import re
import string
from functools import lru_cache, reduce
from operator import add

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gleaner.llm.common import documents, unused

#: Labelled findings that the forest is trained from, trees and depth.
LABELLED, TREES, DEPTH = 3000, 15, 7
#: What a candidate is put between. Every ESCAPED of a text is followed by a sign of its own while marks are in it,
#: so no text holds a mark; pieces get their own signs back.
ESCAPED, ESCAPE, MARK = "\x01", "\x01\x02", "\x01\x03"
REDACTED = "[SECRET]"
#: Pieces whose sizes are summed at once, so that places cost the same in any text.
BLOCK = 128

_KEYS = "password|passwd|pwd|secret|token|api[_-]?key|access[_-]?key|auth[_-]?key|credential"
_RUN = "[A-Za-z0-9+/_=.~-]"
#: A key and its value, or a long run with a digit in it, or a key id of fixed shape.
PATTERN = (
    rf"((?i:{_KEYS})\s{{0,3}}[:=]\s{{0,3}}[\"']?)([^\s\"']{{6,}})"
    rf"|(?<!{_RUN})((?=[A-Za-z+/_=.~-]*[0-9]){_RUN}{{16,}}+|AKIA[A-Z0-9]{{16}})"
)
_DICTIONARY = (
    "the and for that with this from have not are was you all can her his one our out day get has him how man new now old see two way who "
    "boy did its let put say she too use example sample test user admin change password secret token your value name file path key data "
    "home page index version build commit hash order invoice http https www com org net html main class string object return function "
    "tion ing ment able ness less ful ous ive ity ther here there where when what which will would could should about after again"
).split()
_BIGRAMS = "th he in er an re on at en nd ti es or te of ed is it al ar st to nt ng se ha as ou io le ve co me de hi ri ro ic ne ea ra ce"
#: Names, and expressions over x.value, x.left, x.right and path.
_PREFIX = "^(AKIA|ASIA|ghp_|gho_|ghs_|xox[abprs]-|sk-|sk_live_|AIza|eyJ|glpat-|npm_)"
_DOUBT = "(?i)(commit|sha-?1|sha256|md5|uuid|guid|checksum|revision|digest|isbn|order|invoice|phone|card|version|etag|href|src|url)\\W{0,4}$"
_STAND_IN = "(?i)(x{4,}|\\*{3,}|example|sample|changeme|change_me|your[_-]|placeholder|dummy|redacted|123456|<|\\$\\{|\\{\\{|null|none|true|false)"
_TEST_PATH = "(?i)(test|example|sample|fixture|mock|docs?/|readme)"


def features(value: Column, left: Column, right: Column, path: Column) -> list[Column]:
    """The forest's numbers for a candidate between its neighbours."""
    size = F.greatest(F.length(value), F.lit(1))
    share = lambda pattern: F.regexp_count(value, F.lit(pattern)) / size
    flag = lambda condition: F.coalesce(condition, F.lit(False)).cast("int").cast("double")
    lower = F.lower(value)
    words = F.lit("|".join(sorted(_DICTIONARY, key=len, reverse=True)))
    changes = "(?<=[a-z])(?=[^a-z])|(?<=[A-Z])(?=[^A-Z])|(?<=[0-9])(?=[^0-9])"
    near = F.concat_ws(" ", F.right(left, F.lit(40)), F.substring(right, 1, 20))
    return [
        F.length(value).cast("double"),
        share("[0-9]"),
        share("[A-Z]"),
        share("[^A-Za-z0-9]"),
        share(changes),
        F.size(F.array_distinct(F.split(value, ""))) / size,
        (size - F.length(F.regexp_replace(lower, words, F.lit("")))) / size,
        F.regexp_count(lower, F.lit(_BIGRAMS.replace(" ", "|"))) / size,
        flag(value.rlike("^[0-9a-fA-F]+$")),
        flag(value.rlike("^[0-9.,:/_-]+$")),
        flag(value.rlike("^[0-9a-fA-F]{8}-([0-9a-fA-F]{4}-){3}[0-9a-fA-F]{12}$")),
        flag(F.right(left, F.lit(30)).rlike(f"(?i)({_KEYS})\\s{{0,3}}[:=]\\s{{0,3}}[\"']?$")),
        flag(F.right(left, F.lit(30)).rlike(_DOUBT)),
        flag(value.rlike(_PREFIX)),
        flag(value.rlike(_STAND_IN)),
        flag(near.rlike("(?i)(example|placeholder|sample|dummy)")),
        flag(F.right(left, F.lit(3)).rlike("://|/$|@$")),
        flag(path.rlike(_TEST_PATH)),
    ]


def labelled_findings(n: int = LABELLED, seed: int = 7) -> list[tuple[str, str, str, str, int]]:
    """(value, left, right, path, label) made by rule; 1: a secret."""
    r = random.Random(seed)
    pick = lambda letters, size: "".join(r.choice(letters) for _ in range(size))
    upper, alnum, hexa = string.ascii_uppercase + string.digits, string.ascii_letters + string.digits, "0123456789abcdef"
    prose = lambda k: " ".join(pick(string.ascii_lowercase, r.randint(2, 9)) for _ in range(k))
    keyed = lambda: prose(3) + " " + r.choice(["token", "secret", "api_key", "password", "access_key", "passwd"]) + r.choice(["=", " = ", ": ", '="', ' = "'])
    secrets = [
        lambda: ("AKIA" + pick(upper, 16), prose(4) + " "),
        lambda: (r.choice(["ghp_", "gho_"]) + pick(alnum, 36), prose(4) + " "),
        lambda: ("sk-" + pick(alnum, 40), prose(4) + " "),
        lambda: ("xoxb-" + pick(string.digits, 11) + "-" + pick(alnum, 24), prose(4) + " "),
        lambda: (pick(hexa, r.choice([32, 40, 64])), keyed()),
        lambda: (pick(hexa, r.randint(16, 24)), keyed()),
        lambda: (pick(alnum + "+/", 40), keyed()),
        lambda: (pick(alnum + "!#%_-", r.randint(10, 20)), keyed()),
        lambda: ("eyJ" + pick(alnum, 30) + "." + pick(alnum, 40) + "." + pick(alnum, 30), prose(3) + " "),
    ]
    word = lambda: r.choice(_DICTIONARY)
    others = [
        lambda: (pick(hexa, 40), prose(3) + r.choice([" commit ", " revision ", " sha1 ", " sha1: "])),
        lambda: (pick(hexa, r.choice([32, 64])), prose(2) + r.choice([" md5 ", " checksum: ", " sha256:", " digest "])),
        lambda: (f"{pick(hexa, 8)}-{pick(hexa, 4)}-{pick(hexa, 4)}-{pick(hexa, 4)}-{pick(hexa, 12)}", prose(3) + r.choice([" uuid ", " id ", " "])),
        lambda: (pick(string.digits, r.randint(16, 19)), prose(3) + " "),
        lambda: (".".join(str(r.randint(1, 255)) for _ in range(4)) + "-" + pick(string.digits, 6), prose(3) + " "),
        lambda: (f"20{r.randint(10, 29)}-0{r.randint(1, 9)}-1{r.randint(0, 9)}T{pick(string.digits, 6)}", prose(3) + " "),
        lambda: ("-".join(word() for _ in range(4)) + str(r.randint(1, 99)), prose(3) + " "),
        lambda: ("/".join(word() for _ in range(4)) + "/" + str(r.randint(1, 999)) + ".html", prose(2) + " https://"),
        lambda: (word() + "_" + word() + "_" + word() + str(r.randint(1, 9)) + "=" + word(), prose(3) + " "),
        lambda: (r.choice(["changeme", "example123456", "your-token-here1", "xxxxxxxxxxxxxxxx", "placeholder-value-1", "<your_secret>", "${TOKEN}"]), keyed()),
        lambda: (word() + word() + word(), keyed()),
        lambda: (f"{word()}.{pick(string.digits, 2)}@mail{r.randint(1, 9)}.{word()}.com", prose(3) + " "),
        lambda: ("".join(r.choice(_BIGRAMS.split()) for _ in range(r.randint(8, 14))) + str(r.randint(1, 9)), prose(3) + " "),
    ]
    rows = []
    for i in range(n):
        label = i % 2
        value, left = r.choice(secrets if label else others)()
        path = r.choice(["", "src/app.py", "config/prod.env", "notes.txt"] + (["tests/fixture.json", "docs/readme.md"] if not label else []))
        rows.append((value, left, " " + prose(3), path, label))
    return rows


def read_tree(lines: list[str]) -> float | tuple:
    """A printed tree: its vote, or (feature, limit, tree if at most that, tree if more)."""
    line = lines.pop(0).strip()
    if line.startswith("Predict"):
        return float(line.split(":")[1])
    feature, limit = re.match(r"If \(feature (\d+) <= (\S+)\)", line).groups()
    low = read_tree(lines)
    lines.pop(0)  # Else
    return int(feature), float(limit), low, read_tree(lines)


@lru_cache(1)
def fit() -> tuple:
    """The trees of the forest."""
    from pyspark.ml.classification import RandomForestClassifier
    from pyspark.ml.functions import array_to_vector

    spark = SparkSession.getActiveSession()
    rows = spark.createDataFrame(labelled_findings(), "value string, left string, right string, path string, label int").coalesce(1)
    numbers = features(F.col("value"), F.col("left"), F.col("right"), F.col("path"))
    held = rows.select(F.col("label").cast("double").alias("label"), array_to_vector(F.array(*numbers)).alias("features"))
    model = RandomForestClassifier(numTrees=TREES, maxDepth=DEPTH, seed=11).fit(held)
    return tuple(read_tree([x for x in t.toDebugString.split("\n")[1:] if x.strip()]) for t in model.trees)


def forest(s: Column) -> Column:
    """The share of trees that vote for the candidate with features s.f0, s.f1, ..."""

    def case(tree: float | tuple) -> Column:
        if isinstance(tree, float):
            return F.lit(tree)
        feature, limit, low, high = tree
        return F.when(s[f"f{feature}"] <= limit, case(low)).otherwise(case(high))

    return reduce(add, map(case, fit())) / TREES


def with_pieces(df: DataFrame, text: str, path: str | None) -> tuple[DataFrame, str]:
    """Adds the pieces of the text, struct of value, left and score (null for what is between candidates); and their column."""
    split, pieces = unused(df, "_split"), unused(df, "_pieces")
    odd = F.contains(text, F.lit(ESCAPED))
    safe = F.when(odd, F.replace(F.col(text), F.lit(ESCAPED), F.lit(ESCAPE))).otherwise(F.col(text))
    marked = F.split(F.regexp_replace(safe, F.lit(PATTERN), F.lit(f"$1{MARK}$2$3{MARK}")), MARK)
    where = F.coalesce(F.col(path), F.lit("")) if path else F.lit("")
    held = df.withColumn(split, marked)
    own = F.when(odd, F.transform(split, lambda x: F.replace(x, F.lit(ESCAPE), F.lit(ESCAPED)))).otherwise(F.col(split))
    held = held.withColumn(split, own)
    return held.withColumn(pieces, scored(F.col(split), where)).drop(split), pieces


def scored(pieces: Column, path: Column) -> Column:
    """pieces: a column that holds the split text, so that it is split once."""
    near = lambda i: F.coalesce(F.get(pieces, i), F.lit(""))
    names = [f"f{i}" for i in range(18)]
    described = F.transform(
        pieces,
        lambda piece, i: F.struct(
            piece.alias("value"),
            near(i - 1).alias("left"),
            F.when(
                i % 2 == 1,
                F.struct(*(c.alias(n) for c, n in zip(features(piece, near(i - 1), near(i + 1), path), names, strict=True))),
            ).alias("s"),
        ),
    )
    return F.transform(
        described,
        lambda x: F.struct(
            x.value.alias("value"),
            F.right(x.left, F.lit(40)).alias("left"),
            F.when(x.s.isNotNull(), forest(x.s)).alias("score"),
        ),
    )


def kind_of(value: Column, left: Column) -> Column:
    return (
        F.when(value.rlike("^A[KS]IA"), "aws_key")
        .when(value.rlike("^eyJ"), "web_token")
        .when(left.rlike("(?i)(password|passwd|pwd)\\W*$"), "password")
        .when(left.rlike(f"(?i)({_KEYS})\\W*$"), "token")
        .otherwise("key")
    )


def total(sizes: Column) -> Column:
    return F.aggregate(sizes, F.lit(0).cast("long"), lambda a, b: a + b)


def running(sizes: Column) -> Column:
    """What stands before each block of BLOCK pieces. sizes: a column, mentioned more than once and so computed once."""
    blocks = F.transform(F.sequence(F.lit(0), F.floor(F.size(sizes) / BLOCK).cast("int")), lambda b: total(F.slice(sizes, b * BLOCK + 1, F.lit(BLOCK))))
    return F.aggregate(blocks, F.array(F.lit(0).cast("long")), lambda a, b: F.concat(a, F.array(F.element_at(a, -1) + b)))


def find_secrets(df: DataFrame, text: str = "text", path: str | None = None, least: float = 0.5) -> DataFrame:
    """A row for each finding: the other columns of df, and start, value, kind and score."""
    stays = [f"`{c}`" for c in df.columns if c not in (text, "start", "value", "kind", "score")]
    # a filter on the pieces would be pushed below them, and made of them anew
    held, pieces = with_pieces(df.where(F.col(text).rlike(PATTERN)), text, path)
    sizes, bases, one = unused(held, "_sizes"), unused(held, "_bases"), unused(held, "_found")
    rows = held.select(*stays, pieces).withColumn(sizes, F.transform(pieces, lambda x: F.length(x.value)))
    rows = rows.withColumn(bases, running(F.col(sizes)))
    # mentioned twice, and so a column of its own that is computed once
    base = lambda i: F.coalesce(F.get(F.col(bases), F.floor(i / BLOCK).cast("int")), F.get(F.col(bases), F.lit(0)))
    before = lambda i: base(i) + total(F.slice(sizes, i - i % BLOCK + 1, i % BLOCK))
    found = F.transform(
        pieces,
        lambda x, i: F.when(
            x.score >= least,
            F.struct(
                before(i).cast("long").alias("start"), x.value.alias("value"), kind_of(x.value, x.left).alias("kind"), x.score.alias("score")
            ),
        ),
    )
    rows = rows.select(*stays, F.explode(F.filter(found, lambda x: x.isNotNull())).alias(one))
    return rows.select(*stays, f"{one}.*")


def redact(df: DataFrame, text: str = "text", path: str | None = None, least: float = 0.5) -> DataFrame:
    """df with every finding in the text replaced."""
    held, pieces = with_pieces(df, text, path)
    clean = F.array_join(F.transform(pieces, lambda x: F.when(x.score >= least, REDACTED).otherwise(x.value)), "")
    return held.withColumn(text, clean).drop(pieces)


def op5_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, start, size, kind, score and digest of every finding in the documents."""
    found = find_secrets(documents(spark, sf_dir).select("doc_id", "text", "source"), path="source")
    return found.select(
        "doc_id", "start", F.length("value").cast("long").alias("size"), "kind", "score", F.sha2("value", 256).alias("value_sha256")
    )

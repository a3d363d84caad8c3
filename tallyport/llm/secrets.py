"""Secret scans with a random forest that removes false positives.

Candidates are the long runs of key characters with a digit in them, all of a word, and
runs of eight or more after a credential's name and = or :. Each is described
by its length, the changes between character classes inside it, how much of it the
corpus's frequent words cover, whether it looks like a path, address or host, and the
words around it. A random forest trained on labelled findings gives the probability
that a candidate is a secret; the rest are false positives and drop out.

DataFrame functions and Spark's own forest only. The forest is fitted on at most
MAX_TRAIN findings, the first by hash of their place. Every candidate of every whole
text is scored.

Where no labelled findings are given, the unambiguous ones of the corpus serve: a
quoted value after a credential's name is a secret; a run of digits only, an address, a
host, a phone number, a path are not. The forest then judges the rest, and judges these
again.

Defined cases: a null text has no candidates; each occurrence is a finding of its own;
rows that repeat give their findings again; where labelled findings are of one kind
only, every score is that kind's.
"""

from __future__ import annotations

from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyport.llm.common import Stage, let, lower_ascii, table

LEAST = 16
# A value after a credential's name may be shorter, and without a digit.
LEAST_NAMED = 8
KEY = r"A-Za-z0-9+/_.@~\-"
CANDIDATE = rf"[{KEY}:]{{{LEAST},}}"
# Equal signs belong to a run as its padding, unless a value follows them.
TOKEN = rf"[{KEY}:]+(?:={{1,2}}(?!=|[\"']?[{KEY}]))?|[^{KEY}:]+"
KEYS = rf"^[{KEY}]"
LEAD = 6
# Names of credentials, in lower case.
NAMES = r"(token|secret|passwd|password|pwd|api_?key|apikey|access_?key|private_?key|credential|auth)"
# What stands between the end of a credential's name and its value.
ASSIGNS = r"[a-z0-9_-]*[\"']?\s*[=:]"
DICTIONARY = 1_000
MAX_TRAIN = 20_000
TREES, DEPTH, SEED = 20, 6, 7
THRESHOLD = 0.5
FEATURES = ["length", "changes", "digit_share", "upper_share", "letter_runs", "distinct_share", "hex", "digits_only",
            "coverage", "separators", "address", "dotted", "named", "assigned", "quoted", "words_near"]


def dictionary(docs: DataFrame, size: int = DICTIONARY) -> list[str]:
    """The most frequent words of two to eight letters in the whole corpus."""
    words = docs.select(F.explode(F.split(lower_ascii(F.col("text")), r"[^a-z]+")).alias("word"))
    counted = words.filter(F.length("word").between(2, 8)).groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    return [r.word for r in counted.orderBy(F.desc("n"), "word").limit(size).collect()]


def tokens_of(word: Column) -> Column:
    """The word in runs of key characters and runs of others; concatenated they are the word.

    A run is parted at its colons where a part of it is a candidate by itself.
    """
    parted = lambda t: t.contains(":") & F.exists(F.split(t, ":"), lambda p: (F.length(p) >= LEAST) & p.rlike("[0-9]"))
    part = lambda t: F.when(parted(t), F.regexp_extract_all(t, F.lit("[^:]+|:+"), F.lit(0))).otherwise(F.array(t))
    return F.flatten(F.transform(F.regexp_extract_all(word, F.lit(TOKEN), F.lit(0)), part))


def candidates(docs: DataFrame) -> DataFrame:
    """(doc_id, word_at, word, before, before2, after, at, lead, next, candidate) for each candidate.

    `at` is its first character within the word, from 0; `lead` up to LEAD tokens before it.
    A run of LEAST key characters with a digit is one, and so is one of LEAST_NAMED after
    a credential's name and = or :.
    """

    def found(words: Column) -> Column:
        def likely(i: Column) -> Column:
            near = lower_ascii(F.concat_ws(" ", F.get(words, i - 2), F.get(words, i - 1), F.get(words, i)))
            return let(F.get(words, i), lambda w: (F.length(w) >= LEAST_NAMED) & (
                ((F.length(w) >= LEAST) & w.rlike("[0-9]") & w.rlike(CANDIDATE)) | near.rlike(NAMES + ASSIGNS)))

        return F.transform(F.filter(F.sequence(F.lit(0), F.size(words) - 1), likely), lambda i: F.struct(
            i.alias("word_at"), F.get(words, i).alias("word"), F.get(words, i - 1).alias("before"),
            F.get(words, i - 2).alias("before2"), F.get(words, i + 1).alias("after")))

    def hits(of: Column) -> Column:
        tokens = of["tokens"]
        lead = lambda i: F.array_join(F.slice(tokens, F.greatest(i - LEAD, F.lit(0)) + 1, F.least(i, F.lit(LEAD))), "")

        def wanted(i: Column) -> Column:
            head = lower_ascii(F.concat_ws(" ", of["before2"], of["before"], lead(i)))
            return let(F.get(tokens, i), lambda t: t.rlike(KEYS) & (
                ((F.length(t) >= LEAST) & t.rlike("[0-9]")) | ((F.length(t) >= LEAST_NAMED) & head.rlike(NAMES + ASSIGNS + r"\s*[\"']?$"))))

        return F.transform(F.filter(F.sequence(F.lit(0), F.size(tokens) - 1), wanted), lambda i: F.struct(
            F.length(F.array_join(F.slice(tokens, 1, i), "")).alias("at"), lead(i).alias("lead"),
            F.get(tokens, i + 1).alias("next"), F.get(tokens, i).alias("candidate")))

    words = F.split(F.coalesce("text", F.lit("")), r"[\x20\x09-\x0D]+")
    rows = docs.select("doc_id", F.explode(let(words, found)).alias("hit")).select("doc_id", "hit.*")
    of = F.struct(tokens_of(F.col("word")).alias("tokens"), "before", "before2")
    return rows.withColumn("found", F.explode(let(of, hits))).select(*rows.columns, "found.*")


def described(found: DataFrame, words: list[str]) -> DataFrame:
    """`found` with the forest's features."""
    c, n = F.col("candidate"), F.greatest(F.length("candidate"), F.lit(1)).cast("double")
    low = lower_ascii(c)
    shape = F.regexp_replace(F.regexp_replace(F.regexp_replace(c, "[a-z]", "a"), "[A-Z]", "A"), "[0-9]", "0")
    runs = F.filter(F.split(low, "[^a-z]+"), lambda w: F.length(w) >= 2)
    known = F.array(*map(F.lit, words)).cast("array<string>")
    covered = F.aggregate(F.filter(runs, lambda w: F.array_contains(known, w)), F.lit(0), lambda a, w: a + F.length(w))
    near = F.concat_ws(" ", *[lower_ascii(F.col(x)) for x in ("before2", "before", "lead", "candidate")])
    head = F.concat_ws(" ", "before2", "before", "lead")
    number = lambda x: F.coalesce(x, F.lit(False)).cast("double")
    return found.select(
        "*",
        n.alias("length"),
        (F.length(F.regexp_replace(shape, r"(.)\1+", "$1")) / n).alias("changes"),
        (F.regexp_count(c, F.lit("[0-9]")) / n).alias("digit_share"),
        (F.regexp_count(c, F.lit("[A-Z]")) / n).alias("upper_share"),
        F.size(runs).cast("double").alias("letter_runs"),
        (F.size(F.array_distinct(F.split(c, ""))) / n).alias("distinct_share"),
        number(low.rlike("^[0-9a-f]+$")).alias("hex"),
        number(c.rlike("^[0-9:.-]+$")).alias("digits_only"),
        (covered / n).alias("coverage"),
        (F.regexp_count(c, F.lit("[/_.:~-]")) / n).alias("separators"),
        number(c.contains("@")).alias("address"),
        number(c.rlike(r"^([A-Za-z]+:)?[/~]|\.[a-z]{2,4}$")).alias("dotted"),
        number(near.rlike(NAMES)).alias("named"),
        number(head.rlike(r"(=|:)\s*[\"']?$")).alias("assigned"),
        number(F.concat("lead", F.lit(" "), F.coalesce("next", F.lit(""))).rlike("[\"']$|[\"'] | [\"']")).alias("quoted"),
        number(F.col("before").rlike("^[A-Za-z]{2,}[,.]?$") & F.col("after").rlike("^[A-Za-z]{2,}[,.]?$")).alias("words_near"),
    )


def plain_cases(found: DataFrame) -> DataFrame:
    """The findings nobody would argue about, with `is_secret`."""
    secret = (F.col("named") == 1) & (F.col("assigned") == 1) & (F.col("quoted") == 1) & (F.col("length") >= 20)
    other = (F.col("digits_only") == 1) | (F.col("address") == 1) | (F.col("dotted") == 1)
    return found.withColumn("is_secret", F.when(secret, 1.0).when(other, 0.0)).filter("is_secret IS NOT NULL")


def train(labelled: DataFrame, stage: Stage, max_train: int = MAX_TRAIN):
    """A forest on (features, is_secret); a number where all findings are of one kind."""
    some = labelled.orderBy(F.xxhash64("doc_id", "word_at", "at"), "doc_id", "word_at", "at").limit(max_train)
    rows = stage.keep(some.select(*FEATURES, "is_secret"))
    kinds = {r.is_secret for r in rows.select("is_secret").distinct().collect()}
    if len(kinds) < 2:
        return kinds.pop() if kinds else 0.0
    forest = RandomForestClassifier(labelCol="is_secret", featuresCol="vector", numTrees=TREES, maxDepth=DEPTH, seed=SEED)
    return forest.fit(VectorAssembler(inputCols=FEATURES, outputCol="vector").transform(rows))


def judged(found: DataFrame, forest, threshold: float = THRESHOLD) -> DataFrame:
    """Every candidate with `score` and `is_secret`."""
    if isinstance(forest, float):
        score = found.withColumn("score", F.lit(forest))
    else:
        vectors = VectorAssembler(inputCols=FEATURES, outputCol="vector").transform(found)
        score = forest.transform(vectors).withColumn("score", vector_to_array("probability")[1])
    return score.select("doc_id", "word_at", "at", "candidate", "score", (F.col("score") >= threshold).alias("is_secret"))


def scan(docs: DataFrame, labelled: DataFrame | None = None, threshold: float = THRESHOLD) -> DataFrame:
    """(doc_id, word_at, at, candidate, score, is_secret) for each candidate in `docs`.

    `labelled` has doc_id and word_at of findings, `at` where a word has several, and is_secret (1.0 or 0.0).
    """
    given = docs.select("doc_id", "text")
    stage = Stage(docs.sparkSession, "secrets")
    found = stage.keep(described(candidates(given), dictionary(given)))
    on = ["doc_id", "word_at"] + ["at"] * (labelled is not None and "at" in labelled.columns)
    marked = plain_cases(found) if labelled is None else found.join(
        labelled.select(*on, "is_secret"), on)
    return judged(found, train(marked, stage), threshold)


def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = scan(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", "word_at", "at", F.sha2("candidate", 256).alias("candidate_sha256"),
                      F.length("candidate").alias("length"), "score", "is_secret")

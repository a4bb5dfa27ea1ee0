"""Toxicity: gradient-boosted trees over dense text features, with isotonic calibration.

The lexicon is learned from the labelled training rows: words that stand in toxic texts far more
often than in others. Features are densities of lexicon words, their nearness to words of the
second person, capitals, punctuation, and marks of obfuscation (characters inside words that are
no letters, stretched letters). Trees are fitted on part of the training rows; the other part
calibrates their margin by isotonic regression.

`max_rows` bounds the labelled rows that lexicon, trees and calibration learn from. They are taken by the
hash of their id, alike in every run, and from the labels alone: no other text is shuffled. Of rows that
share a labelled id, the smallest text is learned from.

Rows: null and empty texts have zero features and are scored like any other. Repeated rows score
alike. Extra columns are not carried along by `score`. Without training rows, or with one label
only, every score is the share of toxic rows (0 without rows). Labels of one id that disagree count
as toxic. Null labels are left out.
"""

from __future__ import annotations

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import IsotonicRegression
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gristmill.llm.common import bind
from gristmill.llm.minhash import LOWER, UPPER
from gristmill.session import cut

MAX_ROWS = 20_000
LEXICON_WORDS = 150
LEAST_TEXTS = 4
# Words of the second person in the languages of the corpus.
SECOND_PERSON = (
    "you your yours yourself u ur tu toi te ton ta tes vous votre vos du dich dir dein deine "
    "deiner euch euer ihr tú ti tus usted ustedes vosotros os"
).split()
NEAR = 3
FEATURES = (
    "lexicon", "lexicon_distinct", "lexicon_near", "lexicon_any", "second_person", "capitals",
    "exclaims", "punctuation", "symbols", "digits", "mixed", "stretched", "word_length", "log_words",
)


def tokens(text: Column) -> Column:
    """Lower-case words, stripped of all but letters, digits and marks inside."""
    lowered = F.lower(F.coalesce(text, F.lit("")))
    return F.array_remove(F.split(lowered, r"[^\p{L}\p{N}@$*]+"), "")


def lexicon(train: DataFrame, words: int = LEXICON_WORDS, least: int = LEAST_TEXTS) -> list[str]:
    """Words of toxic texts by the log of their odds, best first: at most `words` of them.

    Counts texts by word in a shuffle; only the best words come to the driver.
    """
    each = train.select("toxic", F.explode(F.array_distinct(tokens(F.col("text")))).alias("w"))
    counts = each.groupBy("w").agg(F.sum("toxic").alias("bad"), F.count(F.lit(1)).alias("n"))
    total = train.agg(F.sum("toxic").alias("bad"), F.count(F.lit(1)).alias("n")).first()
    bad, good = total["bad"], total["n"] - total["bad"]
    odds = F.log(((F.col("bad") + 0.5) / (bad + 1)) / ((F.col("n") - F.col("bad") + 0.5) / (good + 1)))
    # two standard errors of the log odds above zero
    error = F.sqrt(1 / (F.col("bad") + 0.5) + 1 / (F.col("n") - F.col("bad") + 0.5))
    scored = counts.where(F.col("bad") >= least).withColumn("score", odds - 2 * error)
    best = scored.where("score > 0.5").orderBy(F.desc("score"), "w").limit(words)
    return [r["w"] for r in best.select("w").collect()]


def features(docs: DataFrame, lex: list[str]) -> DataFrame:
    """`docs` (with `text`) plus the columns of FEATURES."""
    t = F.coalesce(F.col("text"), F.lit(""))
    known = lex or [""]

    def of(w: Column) -> Column:
        n = F.greatest(F.size(w), F.lit(1))
        hit = F.filter(
            F.transform(w, lambda x, i: F.when(x.isin(known), i)), lambda i: i.isNotNull()
        )
        near = F.filter(
            hit,
            lambda i: F.exists(
                F.slice(w, F.greatest(i - NEAR + 1, F.lit(1)), 2 * NEAR + 1),
                lambda x: x.isin(SECOND_PERSON),
            ),
        )
        return F.struct(
            (100 * F.size(hit) / n).alias("lexicon"),
            F.size(F.array_distinct(F.transform(hit, lambda i: F.get(w, i)))).cast("double").alias("lexicon_distinct"),
            (100 * F.size(near) / n).alias("lexicon_near"),
            F.least(F.size(hit), F.lit(20)).cast("double").alias("lexicon_any"),
            (100 * F.size(F.filter(w, lambda x: x.isin(SECOND_PERSON))) / n).alias("second_person"),
            F.log1p(F.size(w)).alias("log_words"),
            (F.char_length(F.array_join(w, "")) / n).alias("word_length"),
            (100 * F.size(F.filter(w, lambda x: x.rlike(r"\p{L}[\p{N}@$*]+\p{L}"))) / n).alias("mixed"),
        )

    size = F.greatest(F.char_length(t), F.lit(1))

    def share(others: str) -> Column:
        return 100 * F.char_length(F.regexp_replace(t, others, "")) / size

    made = docs.withColumn("_w", bind(tokens(F.col("text")), of)).withColumns(
        {
            "capitals": share(r"[^\p{Lu}]+"),
            "exclaims": share(r"[^!?]+"),
            "punctuation": share(r"[^\p{P}]+"),
            "symbols": share(r"[^#*$%&|<>@]+"),
            "digits": share(r"[^0-9]+"),
            "stretched": F.regexp_count(t, F.lit(r"(\p{L})\1\1")) * 100 / size,
        }
    )
    inner = [c for c in FEATURES if c not in made.columns]
    return made.withColumns({c: F.col(f"_w.{c}").cast("double") for c in inner}).drop("_w")


def score(
    docs: DataFrame,
    labels: DataFrame,
    train_on: Column,
    max_rows: int = MAX_ROWS,
    seed: int = 1,
) -> DataFrame:
    """doc_id and score of every row of `docs` (doc_id, text); learns from rows of `labels`
    (doc_id, toxic) for which `train_on`, an expression over doc_id, is true."""
    docs = docs.select("doc_id", "text")
    known = labels.where(train_on & F.col("toxic").isNotNull() & F.col("doc_id").isNotNull())
    known = known.groupBy("doc_id").agg(F.max(F.col("toxic").cast("int")).alias("toxic"))
    # chosen by labels alone, so that no text moves but those that are learned from
    order = F.xxhash64(F.lit(seed), "doc_id")
    n_known = known.count()
    share = F.lit(1.1 * max_rows / max(n_known, 1))
    chosen = known.where(F.shiftrightunsigned(order, 33) / F.lit(float(1 << 31)) < share)
    chosen = chosen.orderBy(order, "doc_id").limit(max_rows)
    train = docs.join(F.broadcast(chosen), "doc_id").groupBy("doc_id", "toxic").agg(F.min("text").alias("text"))
    train = cut(train, "toxicity-train")
    total = train.agg(F.sum("toxic").alias("bad"), F.count(F.lit(1)).alias("n")).first()
    bad, n = total["bad"] or 0, total["n"]
    if not 0 < bad < n:
        return docs.select("doc_id", F.lit(bad / n if n else 0.0).alias("score"))
    lex = lexicon(train)
    third = F.pmod(F.xxhash64(F.lit(seed), "doc_id", "text"), F.lit(3))
    bounded = train.withColumn("fit", third != 0)
    made = VectorAssembler(inputCols=list(FEATURES), outputCol="v")
    rows = cut(features(bounded, lex).select("toxic", "fit", *FEATURES), "toxicity-rows")
    both = rows.groupBy("fit").agg(F.countDistinct("toxic").alias("k")).where("k = 2").count()
    fit = made.transform(rows.where("fit") if both == 2 else rows)
    trees = GBTClassifier(
        featuresCol="v", labelCol="toxic", maxIter=20, maxDepth=3, stepSize=0.3, seed=seed,
        minInstancesPerNode=3,
    ).fit(fit)

    def margin(df: DataFrame) -> DataFrame:
        out = trees.transform(made.transform(df))
        return out.withColumn("margin", vector_to_array("probability")[1])

    held = margin(rows.where("not fit") if both == 2 else rows)
    curve = IsotonicRegression(featuresCol="margin", labelCol="label").fit(
        held.select("margin", F.col("toxic").cast("double").alias("label"))
    )
    ranked = curve.setPredictionCol("calibrated").transform(margin(features(docs, lex)))
    # a trace of the margin orders documents within a step of the curve, without crossing one half
    blend = 0.98 * F.col("calibrated") + 0.02 * F.col("margin")
    kept = F.when(F.col("calibrated") >= 0.5, F.greatest(blend, F.lit(0.5))).otherwise(
        F.least(blend, F.lit(0.499999))
    )
    return ranked.select("doc_id", kept.alias("score"))

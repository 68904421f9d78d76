"""Quality rules: hashed n-gram log-likelihood ratio of a trusted target to the raw corpus.

Words and pairs of neighbours are hashed into `BUCKETS` features. Two smoothed multinomials over
the features are counted: one over the trusted documents, one over the whole corpus. A document's
score is the mean over its features of ``log(p_target / p_raw)``; the mean makes long and short
documents comparable. A fixed threshold decides, so the verdict on a document does not depend on
chance or on the documents beside it, but for the counts.

Everything is built-in expressions on arrays inside the row: texts are never shuffled. What moves
is one count per feature and task, and what is sent to the tasks is one number per feature.

Defined results: a NULL text has no words and fails the base rules; repeated rows are judged each
for itself; with no trusted document all scores are 0; extra columns are ignored by
`verdicts` and kept by `keep_good`.
"""

from __future__ import annotations

from math import log

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from salesmart.llm.common import apart, let, or_empty, with_columns, words_of

#: Number of hashed features.
BUCKETS = 10_000

#: Most labelled documents whose counts make up the target: the bound of the fitted sample.
#: Beyond it those with the smallest hashed ids are taken. Their ids are broadcast, 16 bytes each.
TARGET_DOCS = 100_000

#: Added to each feature's count in both multinomials, after the raw one is scaled to the size of
#: the target: features seen a few times say little, so a small corpus rejects little.
SMOOTHING = 5.0

#: Documents whose mean log ratio is below this are rejected. Clean prose scores about 0 or above.
THRESHOLD = -0.05

# Fixed values of the base rules.
SYMBOLS = r"[#*$%&|<>]"
MIN_WORDS = 50
MAX_REPEATED_PERCENT = 50

DOCUMENT = {"doc_id": "bigint", "text": "string"}
LABEL = {"doc_id": "bigint", "quality": "int", "toxic": "int"}


def features(words: Column) -> Column:
    """Feature numbers, 0 to BUCKETS - 1, of the words and of the pairs of neighbours."""

    def bucket(*parts: Column) -> Column:
        return F.pmod(F.xxhash64(*parts), F.lit(BUCKETS)).cast("int")

    pairs = F.when(F.size(words) >= 2, F.transform(
        F.sequence(F.lit(0), F.size(words) - 2),
        lambda i: bucket(F.get(words, i), F.get(words, i + 1)),
    ))
    none = F.array().cast("array<int>")
    return F.concat(F.transform(words, lambda word: bucket(word)), F.coalesce(pairs, none))


def trusted(labels: DataFrame, most: int = TARGET_DOCS) -> DataFrame:
    """Ids of the documents labelled as good and not toxic, at most ``most`` of them."""
    good = with_columns(labels, LABEL).where(
        "doc_id IS NOT NULL AND quality = 1 AND coalesce(toxic, 0) = 0"
    )
    return good.select("doc_id").distinct().orderBy(F.xxhash64("doc_id"), "doc_id").limit(most)


def log_ratios(docs: DataFrame, labels: DataFrame, most: int = TARGET_DOCS) -> list[float]:
    """``log(p_target / p_raw)`` of every feature: BUCKETS numbers, whatever the corpus."""
    target = trusted(labels, most).withColumn("trusted", F.lit(1))
    rows = (
        with_columns(docs, DOCUMENT)
        .join(F.broadcast(target), "doc_id", "left")
        .select("trusted", F.explode(let(words_of(F.col("text")), features)).alias("bucket"))
    )
    counts = rows.groupBy("bucket").agg(
        F.count(F.lit(1)).alias("raw"), F.count("trusted").alias("target")
    )
    found = {row.bucket: (row.raw, row.target) for row in counts.collect()}
    raw_total = sum(raw for raw, _ in found.values())
    target_total = sum(target for _, target in found.values())
    if not target_total:
        return [0.0] * BUCKETS
    scale = target_total / raw_total
    pairs = (found.get(bucket, (0, 0)) for bucket in range(BUCKETS))
    return [
        round(log((target + SMOOTHING) / (raw * scale + SMOOTHING)), 5) for raw, target in pairs
    ]


def _with_repeats(rows: DataFrame) -> DataFrame:
    """Add ``_repeated``: words of ``_words`` covered by windows of three words that occur twice
    or more in the text.

    Each step is a column of its own, so that Spark compiles the sort.
    """
    word, last = F.col("_words"), F.size("_words") - 3
    grams = F.when(last >= 1, F.transform(
        F.sequence(F.lit(0), last),
        lambda i: F.xxhash64(F.get(word, i), F.get(word, i + 1), F.get(word, i + 2)),
    ))
    placed = F.when(
        F.size(F.array_distinct("_grams")) < F.size("_grams"),
        F.sort_array(F.transform("_grams", lambda g, i: F.struct(g.alias("g"), i.alias("i")))),
    )

    def same(row: Column, at: Column) -> Column:
        return F.coalesce(F.get("_placed", at)["g"] == row["g"], F.lit(False))

    again = F.transform(
        F.filter("_placed", lambda x, k: same(x, k - 1) | same(x, k + 1)), lambda x: x["i"]
    )
    covered = F.array_distinct(F.concat(
        "_again",
        F.transform("_again", lambda i: i + 1),
        F.transform("_again", lambda i: i + 2),
    ))
    return (
        rows.withColumn("_grams", grams)
        .withColumn("_placed", placed)
        .withColumn("_again", again)
        .withColumn("_repeated", F.coalesce(F.size(covered), F.lit(0)).cast("bigint"))
        .drop("_grams", "_placed", "_again")
    )


def judged(
    docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD, most: int = TARGET_DOCS
) -> DataFrame:
    """``docs`` with one more column, ``_quality``: the measures and the verdict on each row."""
    # A constant in the plan: Spark folds the split and the cast into an array of numbers.
    ratios = F.lit(",".join(map(str, log_ratios(docs, labels, most))))
    table = F.split(ratios, ",").cast("array<double>")
    text = or_empty(docs["text"].cast("string"))
    with_word = F.filter(F.split(text, "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]"))
    total = F.aggregate(
        "_features", F.lit(0.0), lambda subtotal, number: subtotal + F.get(table, number)
    )
    n_words = F.size("_words").cast("bigint")
    repeats = F.col("_repeated")
    failed = (n_words < MIN_WORDS) | (100 * repeats > MAX_REPEATED_PERCENT * n_words)
    ratio = F.when(n_words > 0, F.col("_total") / F.size("_features"))
    rows = docs.withColumn("_words", words_of(text)).withColumn("_lines", with_word)
    rows = _with_repeats(rows).withColumn("_features", features(F.col("_words")))
    return rows.withColumn("_total", total).withColumn("_quality", F.struct(
        n_words.alias("n_words"),
        F.length(F.array_join("_words", "")).cast("bigint").alias("word_chars"),
        F.regexp_count(text, F.lit(SYMBOLS)).cast("bigint").alias("n_symbols"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("bigint")
        .alias("n_dup_lines"),
        repeats.alias("n_repeat_words"),
        ratio.alias("log_ratio"),
        failed.alias("base_failed"),
        (~failed & (ratio >= threshold)).alias("kept"),
    )).drop("_words", "_lines", "_repeated", "_features", "_total")


def verdicts(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """One row per document: doc_id, its measures, base_failed, kept and log_ratio."""
    rows = judged(with_columns(docs, DOCUMENT), labels, threshold)
    return rows.select("doc_id", "_quality.*")


def keep_good(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The documents that pass, with all their columns, whatever their names."""
    def passing(docs: DataFrame) -> DataFrame:
        # A column that is not deterministic keeps Spark from pushing the filter below the steps that
        # compute the verdict, which would write each step out in every place that uses it.
        rows = judged(docs, labels, threshold).withColumn("_row", F.monotonically_increasing_id())
        kept = rows.where(F.col("_quality.kept") & (F.col("_row") >= 0))
        return kept.select(*docs.columns)

    return apart(docs, ["doc_id", "text"], passing)


def op1_quality(spark, folder: str) -> DataFrame:
    return verdicts(
        spark.read.parquet(f"{folder}/documents.parquet"),
        spark.read.parquet(f"{folder}/labels.parquet"),
    )

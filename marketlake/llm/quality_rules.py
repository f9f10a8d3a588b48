"""Quality rules: fixed repetition rules, and a log-likelihood ratio of hashed n-grams.

Single words and word pairs are hashed into buckets. Two multinomials over the buckets are counted: the raw corpus
(every document) and the trusted target (documents labelled good and not toxic). A document's score is the mean over
its n-grams of ``log(target / raw)``, so long and short documents compare. Bucket weights are whole micro-nats: sums
are exact, so a verdict never depends on the order of additions. A document is kept if it passes the fixed rules and
its score is at least the threshold, which is fixed by the trusted documents' own scores.

The trusted documents are a bounded sample (``max_trusted`` labelled rows, by hash of their id); the raw counts and
every verdict cover all rows. The model has a fixed size (``BUCKETS`` weights).

Defined results: a NULL or empty text has no words, so it fails the fixed rules; without labels the score decides
nothing; repeated rows each get their row; columns besides the named ones are ignored.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketlake.llm.common import SPACE_RUN, SPACES, bind, stored

BUCKETS = 1 << 14
MICRO = 1_000_000
MAX_TRUSTED = 20_000
SPARE = 1.0  # added to each bucket's count
#: The threshold lies as far below the trusted documents' median as this many times the distance of their 1 % quantile.
SLACK = 2.0
LEAST_WORDS = 20
MOST_REPEATED = 30  # percent of the words
WINDOW = 8


# --- words and n-gram hashes -----------------------------------------------------------------------------------------


def words_of(text: Column) -> Column:
    trimmed = F.btrim(F.coalesce(text, F.lit("")), F.lit(SPACES))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, SPACE_RUN))


def widened(hashes: Column, by: int) -> Column:
    """Hashes of twice the window: the hash at i is joined with the one ``by`` places on."""
    n = F.size(hashes) - by
    return F.when(n <= 0, F.array().cast("array<bigint>")).otherwise(
        F.zip_with(F.slice(hashes, 1, n), F.slice(hashes, by + 1, n), lambda a, b: F.xxhash64(a, b))
    )


def with_grams(docs: DataFrame, text: str) -> DataFrame:
    """``docs`` with its words, the hash of each word and of each word pair."""
    return (
        docs.withColumn("words", words_of(F.col(text)))
        .withColumn("h1", F.transform("words", lambda w: F.xxhash64(w)))
        .withColumn("h2", widened(F.col("h1"), 1))
    )


def repeated_words(grams: Column) -> Column:
    """Words inside windows whose hash occurs twice or more. ``grams``: the hash of the window at each place."""

    def twice(sorted_grams: Column) -> Column:
        n = F.size(sorted_grams)

        def same(item: Column, at: Column) -> Column:
            before = F.get(sorted_grams, at - 1)
            after = F.get(sorted_grams, F.when(at + 1 < n, at + 1).otherwise(-1))
            return F.coalesce(before["g"] == item["g"], F.lit(False)) | F.coalesce(after["g"] == item["g"], F.lit(False))

        return F.sort_array(F.transform(F.filter(sorted_grams, same), lambda item: item["at"]))

    def covered(places: Column) -> Column:
        n = F.size(places)
        steps = F.zip_with(F.slice(places, 1, n - 1), F.slice(places, 2, n - 1), lambda a, b: F.least(b - a, F.lit(WINDOW)))
        return F.aggregate(steps, F.lit(WINDOW), lambda acc, step: acc + step)

    with_places = F.transform(grams, lambda g, at: F.struct(g.alias("g"), at.alias("at")))
    return F.when(
        F.size(F.array_distinct(grams)) < F.size(grams),
        bind(bind(F.sort_array(with_places), twice), covered),
    ).otherwise(0)


def base_columns(text: Column) -> list[Column]:
    """The fixed counts; needs ``words`` and ``h8`` beside ``text``."""
    lines = F.filter(F.split(text, "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]"))
    return [
        F.size("words").cast("bigint").alias("n_words"),
        F.length(F.array_join("words", "")).cast("bigint").alias("word_chars"),
        F.length(F.regexp_replace(text, r"[^#*$%&|<>]+", "")).cast("bigint").alias("n_symbols"),
        bind(lines, lambda own: F.size(own) - F.size(F.array_distinct(own))).cast("bigint").alias("n_dup_lines"),
        repeated_words(F.col("h8")).cast("bigint").alias("n_repeat_words"),
    ]


# --- the model -------------------------------------------------------------------------------------------------------


@dataclass(frozen=True)
class QualityModel:
    """``weights`` in micro-nats per bucket; ``threshold`` in micro-nats per n-gram, None: nothing is rejected."""

    weights: tuple[int, ...]
    threshold: int | None

    def column(self) -> Column:
        return F.split(F.lit(",".join(map(str, self.weights))), ",").cast("array<bigint>")


def bucket(hashed: Column) -> Column:
    return hashed.bitwiseAND(F.lit(BUCKETS - 1)).cast("int")


def score(weights: Column) -> Column:
    """Mean weight of a row's n-grams, rounded down to whole micro-nats; NULL without words."""

    def total(hashes: str) -> Column:
        return F.aggregate(hashes, F.lit(0).cast("bigint"), lambda acc, h: acc + F.get(weights, bucket(h)))

    n = F.size("h1") + F.size("h2")
    return F.when(n > 0, F.floor((total("h1") + total("h2")) / n)).cast("bigint")


def trusted_sample(labels: DataFrame, limit: int = MAX_TRUSTED) -> DataFrame:
    """At most ``limit`` ids of documents labelled good and not toxic, the same ones in every run."""
    good = labels.where("quality = 1 and coalesce(toxic, 0) = 0 and doc_id is not null").select("doc_id").distinct()
    return good.orderBy(F.xxhash64("doc_id"), "doc_id").limit(limit)


def fit(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text: str = "text", max_trusted: int = MAX_TRUSTED
) -> QualityModel:
    """Count both multinomials in one pass, then place the threshold by the trusted documents' scores."""
    trusted = trusted_sample(labels, max_trusted).select(F.col("doc_id").alias("id"), F.lit(1).alias("trusted"))
    rows = docs.select(F.col(id_col).alias("id"), F.col(text).alias("text"))
    # At most max_trusted ids of eight bytes: the size of the broadcast is bounded by that parameter.
    known = rows.join(F.broadcast(trusted), "id", "left")
    grams = with_grams(known, "text").select(F.explode(F.concat("h1", "h2")).alias("h"), "trusted")
    counted = grams.groupBy(bucket(F.col("h")).alias("bucket")).agg(
        F.count("*").alias("raw"), F.count("trusted").alias("target")
    )
    counts = {r["bucket"]: (r["raw"], r["target"]) for r in counted.collect()}  # at most BUCKETS rows
    raw = [counts.get(b, (0, 0))[0] + SPARE for b in range(BUCKETS)]
    target = [counts.get(b, (0, 0))[1] + SPARE for b in range(BUCKETS)]
    weights = micro_weights(raw, target)
    if sum(target) <= SPARE * BUCKETS:
        return QualityModel(weights, None)
    model = QualityModel(weights, None)
    own = with_grams(rows.join(F.broadcast(trusted), "id"), "text").select(score(model.column()).alias("score"))
    low, middle = own.agg(F.percentile("score", F.lit(0.01)), F.percentile("score", F.lit(0.5))).first()
    if middle is None:
        return model
    return QualityModel(weights, int(middle - SLACK * (middle - low) - 1))


def micro_weights(raw: list[float], target: list[float]) -> tuple[int, ...]:
    all_raw, all_target = sum(raw), sum(target)
    return tuple(round(MICRO * math.log((t / all_target) / (r / all_raw))) for r, t in zip(raw, target, strict=True))


def judge(docs: DataFrame, model: QualityModel, text: str = "text") -> DataFrame:
    """(row, verdict) for every row: the row itself, and its fixed counts, ``base_failed``, ``score`` and ``kept``."""
    own = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    rows = docs.select(own.alias("row"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    counted = (
        with_grams(rows, "text")
        .withColumn("h4", widened(F.col("h2"), 2))
        .withColumn("h8", widened(F.col("h4"), 4))
        .select("row", *base_columns(F.col("text")), score(model.column()).alias("score"))
    )
    failed = (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words"))
    passed = F.lit(True) if model.threshold is None else F.col("score") >= model.threshold
    judged = counted.withColumn("base_failed", failed).withColumn("kept", F.when(failed, False).otherwise(passed))
    return judged.select("row", F.struct(*[c for c in judged.columns if c != "row"]).alias("verdict"))


def quality_report(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """All rows of ``docs`` judged by a model fit on them and ``labels``."""
    return judge(docs.select("doc_id", "text"), fit(docs, labels)).select("row.doc_id", "verdict.*")


def good_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs`` that are kept.

    Verdicts are stored before they filter: a filter would otherwise be pushed below the hashes, and every use of a
    hash array would compute it anew.
    """
    return stored(judge(docs, fit(docs, labels)), "judged").where("verdict.kept").select("row.*")

"""Bounded samples of labelled documents for fitting a classifier, and the fold that is held out of them."""

from __future__ import annotations

from collections import Counter

from pyspark.sql import Column, DataFrame, Row, Window
from pyspark.sql import functions as F

from sievemark.llm.inputs import id_and_text


def held_out(folds: int, fold: int) -> Column:
    """Whether a document is in the fold that no classifier learns from; a document without a key always is."""
    return F.coalesce(F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(folds)) == fold, F.lit(True))


def labelled_texts(docs: DataFrame, labels: DataFrame, per_label: int, excerpt: int | None = None) -> list[tuple[str, object]]:
    """Texts and labels of at most `per_label` documents of each label; see `weighted_texts`."""
    return [(text, label) for text, label, _ in weighted_texts(docs, labels, per_label, excerpt)]


def weighted_texts(docs: DataFrame, labels: DataFrame, per_label: int, excerpt: int | None = None) -> list[tuple[str, object, float]]:
    """Texts, labels and weights of the sample, which the driver gets as they are."""
    rows = sample(docs, labels, per_label, excerpt).select("doc_id", "text", "label", "n").collect()
    rows = sorted(rows, key=lambda row: (row["doc_id"], row["text"]))
    return [(row["text"], row["label"], weight) for row, weight in zip(rows, weights_of(rows))]


def sample(docs: DataFrame, labels: DataFrame, per_label: int, excerpt: int | None = None) -> DataFrame:
    """At most `per_label` documents of each label, the same ones whatever the partitioning: doc_id, text, label, n.

    `labels` has doc_id and label; n is the number of labelled documents of the row's label. Texts are whole and of any
    length, or, with `excerpt`, that many characters from a place that depends on the key.
    """
    order = Window.partitionBy("label").orderBy(F.xxhash64("doc_id"), "doc_id")
    known = labels.filter("doc_id IS NOT NULL AND label IS NOT NULL").groupBy("doc_id").agg(F.max("label").alias("label"))
    texts = id_and_text(docs).filter(F.length("text") > 0)
    if excerpt is None:
        known = known.join(texts.select("doc_id"), "doc_id", "left_semi")
    else:
        place = F.pmod(F.xxhash64("doc_id"), F.greatest(F.length("text") - excerpt, F.lit(1))) + 1
        texts = texts.select("doc_id", F.substring("text", place.cast("int"), F.lit(excerpt)).alias("text"))
    # A share of each label that leaves about twice as many as wanted, so that ranking them is a small task.
    counts = known.groupBy("label").agg(F.count("*").alias("n"))  # a row for each label
    share = F.pmod(F.xxhash64("doc_id", F.lit(1)), F.lit(1_000_000)) * F.col("n") < 2_000_000 * per_label
    known = known.join(F.broadcast(counts), "label").filter(share)
    chosen = known.withColumn("place", F.row_number().over(order)).filter(F.col("place") <= per_label).drop("place")
    return texts.join(F.broadcast(chosen), "doc_id").select("doc_id", "text", "label", "n")


def weights_of(rows: list[Row]) -> list[float]:
    """Weights that bring the labels of sample rows back to their shares among all labelled documents.

    A label's documents weigh its count by the number taken, divided so that the least weight is 1.
    """
    taken = Counter(label for _, label in {(row["doc_id"], row["label"]) for row in rows})
    weights = {row["label"]: row["n"] / taken[row["label"]] for row in rows}
    least = min(weights.values(), default=1.0)
    return [weights[row["label"]] / least for row in rows]

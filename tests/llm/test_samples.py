import random

import numpy as np
import pytest

from sievemark.llm import quality, samples, toxicity


@pytest.fixture(scope="module")
def tables(text_spark):
    """Documents with one text, of which one in ten has the rare label."""
    docs = [(key, "one two three four") for key in range(600)]
    labels = [(key, int(key % 10 != 0), int(key % 10 == 0)) for key in range(600)]
    return (
        text_spark.createDataFrame(docs, "doc_id long, text string"),
        text_spark.createDataFrame(labels, "doc_id long, quality int, toxic int"),
    )


def test_weights_bring_back_the_shares_of_labels(tables):
    docs, labels = tables
    rows = samples.weighted_texts(docs, labels.selectExpr("doc_id", "toxic label"), 20)
    assert sorted({(label, weight) for _, label, weight in rows}) == [(0, 9.0), (1, 1.0)] and len(rows) == 40
    every = samples.weighted_texts(docs, labels.selectExpr("doc_id", "toxic label"), 1000)
    assert {weight for _, _, weight in every} == {1.0} and len(every) == 600


def test_scores_follow_the_shares_of_labels_whatever_the_bound(tables):
    docs, labels = tables
    known = labels.filter(~samples.held_out(5, 0))
    toxic_share, good_share = known.selectExpr("avg(toxic)", "avg(quality)").first()
    for bound in (30, 1000):
        field = toxicity.fit(docs, labels, bound)
        (score, _), *_ = toxicity.score_texts(["one two three four"], field, toxicity.Vocabulary(field.weights))
        assert abs(score - toxic_share) < 0.03
        model = quality.fit(docs, labels, bound)
        assert abs(model.scores(np.array([quality.features_of("one two three four")]))[0] - good_share) < 0.03


def prose(draw, n, toxic=False):
    words = ["".join(draw.choice(["the", "ing", "ow", "th", "re"]) for _ in range(draw.randrange(1, 4))) for _ in range(n)]
    return " ".join(draw.choice(["zorgle", "blarg"]) if toxic and draw.random() < 0.05 else word for word in words)


@pytest.fixture(scope="module")
def long_tables(text_spark):
    """Short clean documents, and documents of over 30,000 characters: half of them toxic and bad, half clean."""
    draw = random.Random(8)
    docs = [(key, prose(draw, 50 + key)) for key in range(80)]
    docs += [(key, prose(draw, 7000, toxic=key % 2 == 1)) for key in range(80, 120)]
    assert all((len(text) > 30_000) == (key >= 80) for key, text in docs)
    labels = [(key, int(key < 80 or key % 2 == 0), int(key >= 80 and key % 2)) for key, _ in docs]
    return (
        text_spark.createDataFrame(docs, "doc_id long, text string").repartition(3),
        text_spark.createDataFrame(labels, "doc_id long, quality int, toxic int"),
    )


def test_long_labelled_documents_are_learnt_from(long_tables):
    docs, labels = long_tables
    field = toxicity.fit(docs, labels)
    assert field is not None
    draw = random.Random(9)
    texts = [prose(draw, 60_000), prose(draw, 100), prose(draw, 8000, toxic=True)]
    scores = [score for score, _ in toxicity.score_texts(texts, field, toxicity.Vocabulary(field.weights))]
    assert scores[0] < 0.5 and scores[1] < 0.5 and scores[2] >= 0.5
    good = quality.fit(docs, labels).scores(np.array([quality.features_of(text) for text in texts]))
    assert good[1] > 0.8 > good[2]


def test_a_long_document_counts_with_its_whole_text(text_spark, long_tables):
    docs, labels = long_tables
    field = toxicity.fit(docs, labels)
    late = prose(random.Random(10), 9000) + " zorgle blarg zorgle"
    (row,) = toxicity.facts_of(text_spark.createDataFrame([(1, late)], "doc_id long, text string"), field).collect()
    (alone,) = toxicity.token_chances([late.split()], field, toxicity.Vocabulary(field.weights))
    assert np.allclose((row["highest"], row["expected"]), toxicity.document_facts(alone))
    assert row["highest"] > toxicity.document_facts(alone[:-3])[0]

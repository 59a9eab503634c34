import itertools
import random

import numpy as np
import pytest
from cases import LONG, awkward, by_key

from sievemark.llm import language, quality, toxicity

SYLLABLES = {"aa": ["the", "ing", "ow", "th"], "bb": ["ü", "sch", "ein", "ß"]}


def prose(draw, kind, n=60):
    return " ".join("".join(draw.choice(SYLLABLES[kind]) for _ in range(draw.randrange(1, 4))) for _ in range(n))


@pytest.fixture(scope="module")
def network():
    draw = random.Random(1)
    labels = [draw.choice(["aa", "bb"]) for _ in range(120)]
    return language.train([prose(draw, kind) for kind in labels], labels, epochs=3)


def test_held_out_languages(network):
    draw = random.Random(2)
    labels = [draw.choice(["aa", "bb"]) for _ in range(80)]
    found, scores = language.languages_of([prose(draw, kind, draw.randrange(5, 400)) for kind in labels], network)
    assert np.mean([a == b for a, b in zip(found, labels)]) > 0.95
    assert all(0 <= s <= 1 for s in scores)


def test_gradients_are_those_of_finite_differences(network):
    draw = random.Random(5)
    windows = np.concatenate([language.windows_of(prose(draw, "aa", 10))[0] for _ in range(3)])
    wanted = np.zeros(len(windows), dtype=int)
    loss = lambda: -np.log(network.probabilities(windows)[np.arange(len(windows)), wanted]).mean()
    slopes = language.gradients(network, windows, wanted)
    for name, place in (("out", (3, 0)), ("out_offsets", (1,))):
        value, step = getattr(network, name), 1e-2
        old = value[place]
        value[place] = old + step
        high = loss()
        value[place] = old - step
        low = loss()
        value[place] = old
        assert abs((high - low) / (2 * step) - slopes[name][place]) < 5e-3


def test_awkward_texts_have_languages(text_spark, network):
    found = by_key(language.identify(awkward(text_spark), network))
    assert all(found[key]["lang_pred"] == "und" and found[key]["score"] == 0 for key in (1, 2, 3))
    assert found[4]["lang_pred"] in ("aa", "bb")
    assert language.identify(awkward(text_spark).filter("false"), network).count() == 0
    assert {r["lang_pred"] for r in language.identify(awkward(text_spark), None).collect()} == {"und"}


def test_equal_texts_have_equal_scores(text_spark, network):
    """To the last bit, whatever texts stand beside them and however many."""
    draw = random.Random(6)
    texts = [prose(draw, draw.choice(["aa", "bb"]), draw.randrange(1, 500)) for _ in range(60)]
    together = language.languages_of(texts, network)
    assert [language.languages_of([text], network) for text in texts] == [([a], [b]) for a, b in zip(*together)]
    docs = awkward(text_spark, texts)
    found = [by_key(language.identify(docs.repartition(parts), network)) for parts in (1, 7)]
    assert found[0] == found[1] and [found[0][100 + at]["score"] for at in range(60)] == together[1]


def naive_probabilities(network, text):
    """Every filter at every place, one number at a time."""
    raw = text.encode()
    windows = [raw[at : at + language.WINDOW] for at in range(0, len(raw), language.WINDOW)]
    total = np.zeros(len(network.languages))
    for window in windows:
        seen = window + b" " * (language.WINDOW + max(language.WIDTHS) - 1 - len(window))
        answers = []
        for number in range(network.filters.shape[1]):
            width = language.WIDTHS[number // language.FILTERS]
            best = -np.inf
            for place in range(language.WINDOW):
                value = 0.0
                for at in range(width):
                    for k in range(language.VECTOR):
                        value += float(network.vectors[seen[place + at], k]) * float(network.filters[at * language.VECTOR + k, number])
                best = max(best, value)
            answers.append(max(best + float(network.offsets[number]), 0.0))
        raised = np.exp(np.array(answers) @ network.out + network.out_offsets)
        total += raised / raised.sum() * len(window)
    return total / total.sum()


def test_probabilities_are_those_of_a_naive_convolution(network):
    for text in ("the ing", "sch ein ü " * 30):
        wanted = naive_probabilities(network, text)
        (found,), (score,) = language.languages_of([text], network)
        assert found == network.languages[int(wanted.argmax())] and abs(score - wanted.max()) < 1e-5


def test_whole_query_without_labels(text_spark):
    docs = awkward(text_spark).drop("lang").selectExpr("*", "cast(null as string) lang")
    assert {r["lang_pred"] for r in language.languages(docs).collect()} == {"und"}


def test_marginals_are_those_of_enumeration():
    random_ = np.random.default_rng(3)
    emissions, sizes = random_.normal(size=9), np.array([4, 1, 4])
    firsts, moves, start = np.cumsum(sizes) - sizes, random_.normal(size=(2, 2)), -0.4
    chances, pairs, begin, log_z = toxicity.marginals(emissions, firsts, sizes, moves, start)
    wanted, wanted_pairs, total = np.zeros(9), np.zeros((2, 2)), 0.0
    for first, size in zip(firsts, sizes):
        weights, tags = [], list(itertools.product((0, 1), repeat=size))
        for tag in tags:
            value = start * tag[0] + sum(emissions[first + at] * t for at, t in enumerate(tag))
            weights.append(np.exp(value + sum(moves[a, b] for a, b in zip(tag, tag[1:]))))
        total += np.log(sum(weights))
        for weight, tag in zip(np.array(weights) / sum(weights), tags):
            wanted[first : first + size] += weight * np.array(tag)
            for a, b in zip(tag, tag[1:]):
                wanted_pairs[a, b] += weight
    assert np.allclose(chances, wanted) and np.allclose(pairs, wanted_pairs) and np.isclose(log_z, total)
    assert begin.shape == (3,)


def toxic_texts(draw, n):
    texts, labels = [], []
    for _ in range(n):
        words = prose(draw, "aa", draw.randrange(40, 200)).split()
        bad = draw.random() < 0.3
        for _ in range(4 if bad else 0):
            words.insert(draw.randrange(len(words)), draw.choice(["zorgle", "Blarg", "flump!", "snerkish"]))
        texts.append(" ".join(words))
        labels.append(int(bad))
    return texts, labels


@pytest.fixture(scope="module")
def field():
    return toxicity.train(*toxic_texts(random.Random(3), 250), steps=40)


def test_held_out_toxicity_and_spans(field):
    texts, labels = toxic_texts(random.Random(4), 120)
    found = toxicity.score_texts(texts, field, toxicity.Vocabulary(field.weights))
    assert np.mean([(score >= 0.5) == bool(label) for (score, _), label in zip(found, labels)]) > 0.95
    spans = {text[a:b].lower().strip("!") for text, (_, places) in zip(texts, found) for a, b in places}
    assert {"zorgle", "blarg", "flump", "snerkish"} <= spans
    alone = [toxicity.score_texts([text], field, toxicity.Vocabulary(field.weights))[0][0] for text in texts[:5]]
    assert np.allclose(alone, [score for score, _ in found[:5]])


def test_awkward_texts_have_scores(text_spark, field):
    found = by_key(toxicity.score(awkward(text_spark), field))
    assert found[1]["score"] == found[2]["score"] == found[3]["score"] < 0.5
    assert 0 <= found[4]["score"] <= 1 and found[1]["spans"] == []
    kept = toxicity.scored(awkward(text_spark), field).select("score", "spans").distinct().collect()
    assert [(r["score"], r["spans"]) for r in kept] == [(0.5, [1])]
    assert toxicity.score(awkward(text_spark).filter("false"), field).count() == 0


def labels_of(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")


def test_labels_of_one_kind_or_none(text_spark):
    docs = awkward(text_spark)
    for rows in ([], [(4, 1, 0), (5, 1, 0), (None, 1, 1), (6, None, None), (999, 0, 1)]):
        labels = labels_of(text_spark, rows)
        assert {r["score"] for r in toxicity.toxicity(docs, labels).collect()} == {0.0}
        assert all(0 <= r["score"] <= 1 for r in quality.quality(docs, labels).collect())
    assert quality.quality(docs.filter("false"), labels_of(text_spark, [])).count() == 0


def test_boosted_tables_separate_held_out_rows():
    random_ = np.random.default_rng(1)
    rows = random_.normal(size=(900, len(quality.FEATURES)))
    wanted = (rows[:, 0] + 3 * np.sign(rows[:, 3] * rows[:, 5]) > 0).astype(float)
    model = quality.train(rows[:600], wanted[:600])
    right = (model.scores(rows[600:]) >= 0.5) == wanted[600:].astype(bool)
    assert right.mean() > 0.75  # the pairs carry most of it
    assert {(3, 5)} <= {(a, b) for a, b, _ in model.pairs}


def test_small_tree_is_the_best_of_all_cuts():
    random_ = np.random.default_rng(2)
    slope, curve = random_.normal(size=7), random_.random(7)
    gain = lambda a, b: slope[a:b].sum() ** 2 / (curve[a:b].sum() + 1)
    best = max(gain(0, a) + gain(a, b) + gain(b, 7) for a in range(1, 8) for b in range(a, 8))
    values = quality.small_tree(slope, curve)
    parts = [list(group) for _, group in itertools.groupby(range(7), key=lambda at: values[at])]
    assert np.isclose(sum(gain(p[0], p[-1] + 1) for p in parts), best)


def test_features_of_awkward_texts():
    for text in ("", " ", "\n", "x", "!!!", LONG, "é" * 5, "A" * 100_000):
        found = quality.features_of(text)
        assert len(found) == len(quality.FEATURES) and np.isfinite(found).all()

from sievemark.llm import inputs
from sievemark.llm.samples import sample


def test_a_worker_holds_one_thing_at_a_time():
    made = []

    def make(name):
        return lambda: made.append(name) or [name]

    first = inputs.held("a", 1, make("a1"))
    assert inputs.held("a", 1, make("again")) is first
    inputs.held("b", 1, make("b1"))
    assert list(inputs._HELD) == [("b", 1)]
    inputs.held("b", 2, make("b2"))
    assert list(inputs._HELD) == [("b", 2)] and made == ["a1", "b1", "b2"]
    assert inputs.held("a", 1, make("a1")) is not first


def test_label_counts_are_joined_without_shuffling_by_label(text_spark):
    docs = text_spark.range(60).selectExpr("id doc_id", "concat('text ', id) text")
    labels = text_spark.range(60).selectExpr("id doc_id", "cast(id % 20 = 0 as int) label")
    found = sample(docs, labels, 10)
    rows = found.collect()
    assert sorted(r["label"] for r in rows) == [0] * 10 + [1] * 3 and {(r["label"], r["n"]) for r in rows} == {(0, 57), (1, 3)}
    # Only the few rows left after the share of each label are ranked by label.
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "strategy=broadcast" in plan

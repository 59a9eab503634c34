import random

import corpus_pipeline


def test_texts_that_share_a_key_are_documents_of_their_own(text_spark):
    draw = random.Random(14)
    one, other, third, fourth = (" ".join(f"w{draw.randrange(10**6)}" for _ in range(80)) for _ in range(4))
    rows = [(5, one), (5, other), (3, other + " more"), (7, third), (7, fourth), (7, fourth), (9, fourth), (8, None), (8, ""), (None, one)]
    docs = text_spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    kept = sorted(map(tuple, corpus_pipeline.drop_near_copies(text_spark, docs, "").collect()), key=repr)
    assert kept == sorted([(5, one), (3, other + " more"), (7, third), (7, fourth), (8, None), (8, ""), (None, one)], key=repr)

import itertools
import random
import re
import zlib
from pathlib import Path

import pytest
from cases import awkward

import corpus_pipeline
from sievemark.llm import toxicity
from sievemark.llm.tokens import Encoder, default_path

COLUMNS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="module")
def passage():
    draw = random.Random(13)
    return " ".join("".join(draw.choice(["the", "ing", "ow", "th", "re"]) for _ in range(draw.randrange(1, 5))) for _ in range(14))


@pytest.fixture(scope="module")
def folder(passage, text_spark, tmp_path_factory):
    draw = random.Random(12)
    word = lambda: "".join(draw.choice(["the", "ing", "ow", "th", "re"]) for _ in range(draw.randrange(1, 5)))
    prose = lambda n: " ".join(word() for _ in range(n))
    rows, labels = [], []
    for key in range(120):
        text = prose(draw.randrange(50, 120))
        if key % 4 == 0:
            words = text.split()
            for _ in range(5):
                words.insert(draw.randrange(len(words)), draw.choice(["zorgle", "blarg", "flump"]))
            text = " ".join(words)
        labels.append((key, 1, int(key % 4 == 0)))
        rows.append((key, text))
    base = prose(100)
    rows += [(500, base), (501, base), (502, base + " extra words"), (503, "before " + passage + " after"), (504, "mail a@b.example.com now"), (505, None), (506, "")]
    rows += [(500, base), (None, "no key")]
    docs = [(key, text, "en", "s", len(text or "")) for key, text in rows]
    path = tmp_path_factory.mktemp("tables")
    text_spark.createDataFrame(docs, COLUMNS).write.parquet(f"{path}/documents.parquet")
    text_spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    text_spark.createDataFrame([(1, passage)], "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    return str(path), rows


def test_each_stage_does_its_part(text_spark, folder):
    path, rows = folder
    docs = text_spark.read.parquet(f"{path}/documents.parquet")
    kept = {}
    for name, stage in corpus_pipeline.STAGES:
        out = stage(text_spark, docs, path)
        if name != "packing":
            assert out.columns == docs.columns
        kept[name] = [r.asDict() for r in out.collect()]
        docs = out
    toxic = {key for key, text in rows if key is not None and key < 120 and key % 4 == 0}
    clean = {key for key, _ in rows if key not in toxic}
    assert {r["doc_id"] for r in kept["toxicity"]} >= clean
    assert len(toxic & {r["doc_id"] for r in kept["toxicity"]}) <= 2
    after = [r["doc_id"] for r in kept["near copies"]]
    assert len(after) == len(set(after)) and {500, None, 505, 506} <= set(after) and not {501, 502} & set(after)
    assert 503 not in {r["doc_id"] for r in kept["decontamination"]} and 504 in {r["doc_id"] for r in kept["decontamination"]}
    mail = next(r for r in kept["personal data"] if r["doc_id"] == 504)
    assert mail["text"] == "mail [EMAIL] now" and mail["n_chars"] == len(mail["text"])
    encode = Encoder(default_path())
    tokens = sum(len(encode.document(r["text"])) // 4 for r in kept["personal data"])
    assert sum(r["length"] for r in kept["packing"]) == tokens


WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words_of(text):
    return WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def plain_run(rows, passage, field):
    """What the five stages should keep, in plain Python with the fitted field as given: documents before packing."""
    texts = [text or "" for _, text in rows]
    scores = [toxicity.score_texts([text], field, toxicity.Vocabulary(field.weights))[0][0] for text in texts]
    rows = [row for row, score in zip(rows, scores) if score < 0.5]
    # One row of each group of near copies; rows without a key are no documents of a group.
    keyed = sorted({row for row in rows if row[0] is not None}, key=lambda row: (row[0], row[1] or ""))
    sets = []
    for _, text in keyed:
        words = words_of(text)
        sets.append({tuple(words[at : at + 5]) for at in range(max(1, len(words) - 4))} if words else set())
    group = list(range(len(keyed)))
    for a, b in itertools.combinations(range(len(keyed)), 2):
        if sets[a] and len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b]):
            old, new = max(group[a], group[b]), min(group[a], group[b])
            group = [new if g == old else g for g in group]
    rows = [row for at, row in enumerate(keyed) if group[at] == at] + [row for row in rows if row[0] is None]
    item = words_of(passage)
    windows = {tuple(item[at : at + 10]) for at in range(len(item) - 9)}
    clean = lambda words: not any(tuple(words[at : at + 10]) in windows for at in range(len(words)))
    rows = [row for row in rows if clean(words_of(row[1]))]
    return [(key, re.sub(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "[EMAIL]", text) if text else text) for key, text in rows]


def test_run_gives_what_plain_stages_give(text_spark, folder, passage):
    path, rows = folder
    docs = text_spark.read.parquet(f"{path}/documents.parquet")
    field = toxicity.fit(docs, text_spark.read.parquet(f"{path}/labels.parquet"))
    encode = Encoder(default_path())
    wanted = []
    for key, text in plain_run(rows, passage, field):
        ids = [*encode.whole.encode(text or "", add_special_tokens=False).ids, 1]
        for piece, start in enumerate(range(0, len(ids), 4096)):
            part = ids[start : start + 4096]
            wanted.append((key, piece, start, len(part), zlib.crc32(b"".join(i.to_bytes(4, "little") for i in part))))
    found = corpus_pipeline.run(text_spark, path).collect()
    assert sorted(map(repr, wanted)) == sorted(repr((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"])) for r in found)
    sequences = {}
    for r in found:
        sequences.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for held in sequences.values():
        assert [offset for offset, _ in sorted(held)] == [sum(n for _, n in sorted(held)[:at]) for at in range(len(held))]
        assert sum(n for _, n in held) <= 4096
    assert len(sequences) <= -(-sum(row[3] for row in wanted) // 4096) + 1


def test_only_the_result_is_left(text_spark, folder):
    path, _ = folder
    scratch = Path(text_spark.conf.get("spark.checkpoint.dir")) / "materialised"
    before = set(scratch.iterdir()) if scratch.exists() else set()
    assert corpus_pipeline.run(text_spark, path).count() > 0
    assert len(set(scratch.iterdir()) - before) == 1


def test_run_writes_and_rereads_each_stage(text_spark, folder, monkeypatch):
    path, _ = folder
    monkeypatch.setattr(corpus_pipeline, "STAGES", corpus_pipeline.STAGES[2::2])
    rows = corpus_pipeline.run(text_spark, path).collect()
    assert {"doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"} == set(rows[0].asDict())
    assert 503 not in {r["doc_id"] for r in rows} and 504 in {r["doc_id"] for r in rows}


def test_awkward_and_empty_documents_pass_every_stage(text_spark, folder):
    path, _ = folder
    for docs in (awkward(text_spark), awkward(text_spark).filter("false")):
        for name, stage in corpus_pipeline.STAGES:
            out = stage(text_spark, docs, path)
            if name != "packing":
                assert out.columns == docs.columns
                assert {r["score"] for r in out.select("score").collect()} <= {0.5}
            out.count()


def test_no_labels_keep_all(text_spark, folder):
    path, _ = folder
    docs = awkward(text_spark)
    assert toxicity.scored(docs, None).filter("_score < 0.5").count() == docs.count()

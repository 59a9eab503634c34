import hashlib
import random
import re

import pytest
from cases import awkward, by_key

from sievemark.llm import secret_scan as s

KEYWORDS = "[pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY]"
PATTERNS = {
    "assign": rf"({KEYWORDS})[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)",
    "access": r"AKIA[A-Z0-9]+",
    "hex": r"[0-9a-f]+",
}


def brute(text):
    spans = []
    for order, (kind, pattern) in enumerate(PATTERNS.items()):
        for m in re.finditer(pattern, text or ""):
            good = {"assign": kind == "assign" and len(m.group(2)) >= 12, "access": len(m.group()) >= 18, "hex": len(m.group()) >= 16}[kind]
            if good:
                spans.append((m.start(), order, m.end(), kind))
    return [f"{kind}:{a}:{b}" for a, _, b, kind in sorted(spans)]


def prose(draw, n):
    parts = ["sch", "ein", "er", "the", "ing", "tion", "de", "los", "que", "ment", "ar", "and"]
    return " ".join("".join(draw.choice(parts) for _ in range(draw.randrange(1, 7))) for _ in range(n))


def key(draw, size, family=s.FAMILIES[2]):
    return "".join(draw.choice(family) for _ in range(size))


def test_base_spans_are_those_of_the_patterns(text_spark):
    draw = random.Random(4)
    parts = ["password", "PassWd", "toKen", "ſecret", "toKen", "secret", "api_key", "APIKEY", '"', "'", " ", "  ", ":", "=", "é", "漢🙂", "\n", ".", "-",
             "AKIA", "AKIAABCDEFGHIJKLMN", "0123456789abcdef", "deadbeef", "abcdefghijkl", "ABCDEFGHIJKLM", "x" * 11, "1" * 16]
    texts = ["".join(draw.choice(parts) for _ in range(draw.randrange(1, 16))) for _ in range(500)]
    texts += ["a" * 60_000, "token" * 5000, "token=" * 4000, "AKIA" * 3000, "password" + " " * 50_000 + "= abcdefghijklmnop"]
    docs = awkward(text_spark, texts)
    found = by_key(s.secrets(docs))
    for row in docs.collect():
        wanted, got = brute(row["text"]), found[row["doc_id"]]
        assert got["base_sha256"] == hashlib.sha256(",".join(wanted).encode()).hexdigest(), row["text"][:200]
        assert [got[f"n_{kind}"] for kind in PATTERNS] == [sum(w.startswith(kind) for w in wanted) for kind in PATTERNS]
        spans = [span for span in got["spans"].split(",") if span]
        assert [span for span in spans if not span.startswith("random")] == wanted
        assert spans == sorted(spans, key=lambda span: (int(span.split(":")[1]), s.KINDS.index(span.split(":")[0])))
        assert len(spans) - len(wanted) == got["n_random"]


def scored(model, run):
    """Best stretch of a run, tried at every begin and end."""
    best, found = s.LOG_ODDS, None
    symbols = [0, *(s.ALPHABET.index(c) + 1 for c in run), 0]
    for ratios in model.ratios:
        for begin in range(len(run)):
            total = 0.0
            for step in range(begin, len(run) + 1):
                total += ratios[symbols[step], symbols[step + 1]]
                end = min(step + 1, len(run))
                if total - s.math.log(len(model.ratios)) > best + 1e-9:
                    best, found = total - s.math.log(len(model.ratios)), (begin, end)
    return found if found and found[1] - found[0] >= s.LEAST_RANDOM else None


@pytest.fixture(scope="module")
def model(text_spark):
    draw = random.Random(1)
    return s.train(awkward(text_spark, [prose(draw, 60) + f' token = "{key(draw, 40, s.HEX)}"' for _ in range(60)]))


def test_stretches_are_the_best_ones(model):
    draw = random.Random(7)
    for _ in range(60):
        run = "".join(draw.choice([key(draw, 18), "getUserName", "customer_order", key(draw, 7, s._DIGITS), key(draw, 30, s.FAMILIES[5])]) for _ in range(draw.randrange(2, 5)))
        symbols = s.np.array([0, *(s.ALPHABET.index(c) + 1 for c in run), 0])
        wanted, got = scored(model, run), s.best_stretch(model.ratios[:, symbols[:-1], symbols[1:]])
        assert got == wanted or (got and wanted and abs(got[0] - wanted[0]) + abs(got[1] - wanted[1]) <= 2)


def test_random_strings_are_told_from_identifiers(text_spark, model):
    draw = random.Random(9)
    made = [(family, size) for family in s.FAMILIES for size in (24, 32, 40)]
    randoms = [f"{prose(draw, 5)} <{key(draw, size, family)}> {prose(draw, 5)}" for family, size in made * 6]
    ordinary = [f"{prose(draw, 5)} <{'_'.join(draw.choice(s.WORDS) for _ in range(5))}> {''.join(draw.choice(s.WORDS).capitalize() for _ in range(6))}" for _ in range(300)]
    ordinary += [f"{prose(draw, 30)} {draw.randrange(10**15, 10**16)} {'sch' * 9} 2024-01-01-23-59-59-000 /usr/local/share/config/server/index" for _ in range(100)]
    rows = list(enumerate(randoms + ordinary))
    docs = text_spark.createDataFrame(rows, "doc_id long, text string")
    found = by_key(s.secret_spans(docs, model))
    caught = sum(bool(found[at]["spans"]) for at in range(len(randoms))) / len(randoms)
    false = [found[at]["text"] for at in range(len(randoms), len(rows)) if any(span["kind"] == "random" for span in found[at]["spans"])]
    assert caught >= 0.97 and not false


def test_masking_keeps_nulls_and_other_columns(text_spark):
    draw = random.Random(2)
    secret = key(draw, 40)
    docs = awkward(text_spark, ["x api_key='abcdefghijklmnop' y", f"ümläut {secret} end", "0123456789abcdef0"])
    out = s.masked(docs)
    assert out.columns == docs.columns
    found = {row["doc_id"]: row["text"] for row in out.collect()}
    assert found[1] is None and found[2] == "" and found[5].startswith("one two")
    assert found[100] == "x [SECRET]' y" and found[101] == "ümläut [SECRET] end" and found[102] == "[SECRET]"
    assert s.masked(docs.filter("false")).count() == 0 and s.secrets(docs.filter("false")).count() == 0


def test_counts_cover_every_text_in_any_partitioning(text_spark):
    draw = random.Random(3)
    docs = awkward(text_spark, [prose(draw, 40) for _ in range(30)])
    a, b = s.train(docs.repartition(1)), s.train(docs.repartition(7))
    assert (a.ratios == b.ratios).all() and not (a.ratios == s.train(docs.filter("doc_id < 110")).ratios).all()

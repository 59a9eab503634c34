import random
import re

from cases import awkward, by_key

from sievemark.llm import contamination as c

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def fold(text):
    return "".join(chr(ord(x) + 32) if "A" <= x <= "Z" else x for x in text)


def brute(text, items, size=10):
    words, hit, found = WORD.findall(fold(text or "")), set(), set()
    for key, item in items:
        own = WORD.findall(fold(item or ""))
        for at in range(max(1, len(own) - size + 1)) if own else ():
            window = own[at : at + size]
            for place in range(len(words) - len(window) + 1):
                if words[place : place + len(window)] == window:
                    hit.update(range(place, place + len(window)))
                    found.add(str(key))
    return len(words), len(hit), len(found), c.digest(found)


def benchmark(spark, items):
    return spark.createDataFrame(items, "item_id long, text string")


def make(draw, n):
    return " ".join(draw.choice(["ab", "Ab", "c", "d-e", "é", "Ñ", "9", "漢"]) for _ in range(n))


def test_hits_are_those_of_brute_force(text_spark):
    draw = random.Random(4)
    items = [(at, make(draw, draw.randrange(0, 16))) for at in range(12)] + [(20, None), (21, "--"), (22, "one two three"), (23, "One, TWO; three")]
    texts = [make(draw, draw.randrange(0, 60)) + " | " + (draw.choice(items)[1] or "") + "! " + make(draw, 3) for _ in range(60)]
    docs = awkward(text_spark, texts)
    found = by_key(c.contamination(docs, benchmark(text_spark, items)))
    for row in docs.collect():
        got = found[row["doc_id"]]
        assert (got["n_words"], got["n_hit"], got["n_items"], got["items_sha256"]) == brute(row["text"], items)
        assert got["contaminated"] == (got["n_hit"] > 0)
    blocks = by_key(c.find_passages(docs, benchmark(text_spark, items), most_bytes=40))
    for key, row in by_key(c.find_passages(docs, benchmark(text_spark, items))).items():
        assert blocks[key] == row


def test_empty_sides(text_spark):
    none = benchmark(text_spark, []).filter("false")
    assert {r["n_hit"] for r in c.contamination(awkward(text_spark), none).collect()} == {0}
    assert c.contamination(awkward(text_spark).filter("false"), none).count() == 0


def test_offsets_lead_back_to_the_text():
    items = (("7", "who wrote it"),)
    text = "So: WHO -- wrote\nit? Nobody; who wrote it."
    _, hit, _ = c.scan(text, c.automaton(items, 10))
    assert [text[a:b] for a, b in c.spans_of(text, hit)] == ["WHO -- wrote\nit", "who wrote it"]

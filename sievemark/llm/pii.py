"""Personal data and secrets in whole texts, found and redacted with built-in column functions only.

Base spans are the leftmost non-overlapping matches of one pattern a kind that pass the kind's check. High-recall
generators then propose further spans, which may overlap: numbers inside matches that failed, phones without a plus,
spelt-out and spaced addresses, cards in groups, and runs of key characters that may be secrets. Boosted trees rate each
proposal by its format and the characters around it; proposals of at least the calibrated threshold of their kind that overlap
no span of their kind (a secret: no base span) are added.

The trees are fitted when the operator starts, to a bounded sample of examples. One part are proposals in the documents
themselves: those that are base spans, and those that fail their kind's check. The others are labelled forms set into
words of the documents, since no table labels them. All features come from the same expressions as those of documents.

Patterns use possessive runs that start where a run starts (or where the last match ended), so that a long run of
letters or digits is read once. Null and empty texts have no spans; rows with equal keys or texts get equal ones. Of
proposals that clash, the first by begin, kind and end stays. Offsets count code points; ends are exclusive.
"""

from __future__ import annotations

import json
import random

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sievemark.llm import boosted
from sievemark.llm.inputs import id_and_text

KINDS = ("email", "ip", "card", "phone", "secret")
SECRET = KINDS.index("secret")
_NAME = "[A-Za-z0-9._%+-]"
_HOST = "[A-Za-z0-9-]"

# What the base patterns of the four kinds match, and where numbers stand in a proposal's context.
BASE = {
    "email": rf"(?:\G|(?<!{_NAME})){_NAME}++@{_HOST}++(?:\.{_HOST}++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
_AT, _DOT = r"(?: ?[\[({] ?(?:at|AT) ?[\])}] ?)", r"(?: ?[\[({] ?(?:dot|DOT) ?[\])}] ?|\.)"
_KEY = "[A-Za-z0-9+/_-]"
GENERATORS = (
    ("email", rf"(?<!{_NAME}){_NAME}{{1,64}}+{_AT}{_HOST}{{1,63}}(?:{_DOT}{_HOST}{{1,63}})+"),
    ("email", rf"(?<!{_NAME}){_NAME}{{1,64}}+ (?:at|AT) {_HOST}{{1,63}}(?: (?:dot|DOT) {_HOST}{{1,63}})+"),
    ("email", rf"(?<!{_NAME}){_NAME}{{1,64}}+ ?@ ?{_HOST}{{1,63}}(?: ?\. ?{_HOST}{{1,63}})+"),
    ("ip", r"(?<![0-9.])[0-9]{1,3}\.[0-9]{1,3}\.[0-9]{1,3}\.[0-9]{1,3}(?![0-9])"),
    ("card", r"(?<![0-9])(?:[0-9]{4}[ .-]){3}[0-9]{4}(?![0-9])|(?<![0-9])[0-9]{4}[ .-][0-9]{6}[ .-][0-9]{5}(?![0-9])|(?<![0-9])[0-9]{15,16}(?![0-9])"),
    ("phone", r"\+[0-9]{1,3} ?\(?[0-9]{2,4}\)?[ .-]?[0-9]{3,4}[ .-]?[0-9]{3,4}(?![0-9])"),
    ("phone", r"(?<![0-9+.-])(?:\([0-9]{3}\) ?|[0-9]{3}[ .-])[0-9]{3}[ .-][0-9]{4}(?![0-9.-])"),
    ("secret", rf"(?<!{_KEY})(?={_KEY}{{0,40}}[0-9])(?={_KEY}{{0,40}}[A-Za-z]){_KEY}{{16,}}+"),
)
CONTEXT = {
    "email": "mail|contact|write|adress",
    "ip": "ip|host|server|address|login",
    "card": "card|visa|pay|credit|karte|tarjeta|carte",
    "phone": "phone|tel|call|fax|mobil|whatsapp",
    "secret": "token|secret|passw|api.?key|access.?key|bearer|credential",
}
CONTEXT_CHARS = 40
FEATURES = ("kind", "chars", "digits", "separators", "letters", "switches", "luhn", "plus", "brackets", "octets", "signs", "glued_before", "glued_after", "assigned", "hint")

# Bounds of the sample that the trees are fitted to: distinct texts, proposals for each kind and label, labelled forms.
SAMPLE_TEXTS, PER_LABEL, FORMS = 2000, 300, 1500

SPAN = "struct<begin: int, end: int, kind: int>"


def digits_of(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """Whether digits end with their Luhn check digit."""
    size = F.length(digits)

    def weight(at: Column) -> Column:
        digit = F.substring(digits, size - at, F.lit(1)).try_cast("int")
        return F.when(at % 2 == 0, digit).otherwise(digit * 2 - F.when(digit > 4, 9).otherwise(0))

    total = F.aggregate(F.sequence(F.lit(0), size - 1), F.lit(0), lambda sum_, at: sum_ + weight(at))
    return (size > 0) & (total % 10 == 0)


def octets(text: Column) -> Column:
    """Whether all numbers between dots are at most 255."""
    value = lambda part: F.regexp_replace(part, "^0+(?=[0-9])", "")
    small = lambda part: (F.length(value(part)) <= 3) & (F.substring(value(part), 1, 3).try_cast("int") <= 255)
    return F.forall(F.split(text, r"\."), small)


def _valid(kind: str, text: Column) -> Column:
    if kind == "ip":
        return octets(text)
    if kind == "card":
        digits = F.regexp_replace(text, "[ -]", "")
        return F.length(digits).between(12, 19) & F.when(F.length(digits).between(12, 19), luhn(digits)).otherwise(False)
    if kind == "phone":
        return F.length(digits_of(text)).between(9, 15)
    return F.lit(True)


def matches(text: Column, pattern: str, keep, make) -> Column:
    """Kept leftmost non-overlapping matches of a pattern in order, each made from its place and string.

    The text between matches and the matches themselves come from two passes of the same pattern; their lengths add up
    to the places. Only kept matches are gathered.
    """
    between, found = F.split(text, pattern, -1), F.regexp_extract_all(text, F.lit(pattern), 0)
    pairs = F.zip_with(F.slice(between, F.lit(1), F.size(found)), found, lambda gap, hit: F.struct(F.length(gap).alias("gap"), hit.alias("hit")))
    made = make(F.lit(0), F.lit(""))
    start = F.struct(F.lit(0).alias("at"), F.filter(F.array(made), lambda _: F.lit(False)).alias("kept"))

    def step(state: Column, pair: Column) -> Column:
        begin = state["at"] + pair["gap"]
        kept = F.when(keep(pair["hit"]), F.concat(state["kept"], F.array(make(begin, pair["hit"])))).otherwise(state["kept"])
        return F.struct((begin + F.length(pair["hit"])).alias("at"), kept.alias("kept"))

    return F.aggregate(pairs, start, step, lambda state: state["kept"])


def _span(kind: int):
    return lambda begin, hit: F.struct(begin.alias("begin"), (begin + F.length(hit)).alias("end"), F.lit(kind).alias("kind"))


def base_spans(text: Column) -> dict[str, Column]:
    """Base spans of each kind."""
    return {kind: matches(text, BASE[kind], lambda hit, kind=kind: _valid(kind, hit), _span(KINDS.index(kind))) for kind in BASE}


def proposals(text: Column) -> Column:
    """Proposed spans of all generators with their features."""

    def make(kind: str):
        def of(begin: Column, hit: Column) -> Column:
            end = begin + F.length(hit)
            before = F.lower(F.substring(text, F.greatest(begin - CONTEXT_CHARS, F.lit(0)) + 1, F.least(begin, F.lit(CONTEXT_CHARS))))
            after, digits = F.substring(text, end + 1, F.lit(1)), digits_of(hit)
            values = {
                "kind": F.lit(KINDS.index(kind)),
                "chars": F.length(hit),
                "digits": F.length(digits),
                "separators": F.length(F.regexp_replace(hit, "[^ .()-]", "")),
                "letters": F.length(F.regexp_replace(hit, "[^A-Za-z]", "")),
                "switches": F.length(F.regexp_replace(F.regexp_replace(hit, "[A-Za-z]+", "a"), "[0-9]+", "0")),
                "luhn": F.when(F.length(digits).between(12, 19), luhn(digits)).otherwise(False).cast("int"),
                "plus": F.startswith(hit, F.lit("+")).cast("int"),
                "brackets": F.contains(hit, F.lit("(")).cast("int"),
                "octets": (octets(hit) if kind == "ip" else F.lit(False)).cast("int"),
                "signs": F.length(F.regexp_replace(hit, r"[^\[({+/_@-]", "")),
                "glued_before": F.rlike(before, F.lit(r"[\p{L}\p{N}_.=/#-]$")).cast("int"),
                "glued_after": F.rlike(after, F.lit(r"[\p{L}\p{N}_=/-]")).cast("int"),
                "assigned": F.rlike(before, F.lit(r"""[:=]\x20?["'`]?$""")).cast("int"),
                "hint": F.rlike(before, F.lit(CONTEXT[kind])).cast("int"),
            }
            features = F.array(*(values[name].cast("double") for name in FEATURES))
            return F.struct(begin.alias("begin"), end.alias("end"), F.lit(KINDS.index(kind)).alias("kind"), features.alias("features"))

        return of

    return F.concat(*(matches(text, pattern, lambda hit: F.lit(True), make(kind)) for kind, pattern in GENERATORS))


def forms(around: list[str], seed: int = 3, count: int = FORMS) -> list[dict]:
    """Labelled forms, one a row, each between two of the given pieces of text: text, good."""
    draw = random.Random(seed)
    pick = lambda size, signs: "".join(draw.choice(signs) for _ in range(size))
    number = lambda size: pick(size, "0123456789")
    byte = lambda: str(draw.randrange(256))
    words = "the of and was on from report value order seen page".split()
    fill = lambda: draw.choice(around) if around and draw.random() < 0.7 else " ".join(draw.choices(words, k=draw.randrange(2, 7)))
    word = lambda: draw.choice("user name index value count build page image data order report total final draft".split())

    def card(valid: bool) -> str:
        digits = [draw.randrange(10) for _ in range(15)]
        total = sum(d if at % 2 else (d * 2 - 9 if d > 4 else d * 2) for at, d in enumerate(digits))
        digits.append((-total + (0 if valid else draw.randrange(1, 10))) % 10)
        text, mark = "".join(map(str, digits)), draw.choice(["", " ", ".", "-"])
        return mark.join(text[at : at + 4] for at in range(0, 16, 4))

    def key() -> str:
        hexes, mixed = "0123456789abcdef", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789"
        made = draw.choice([pick(40, hexes), pick(32, hexes), pick(64, hexes), pick(40, mixed), pick(24, mixed), pick(32, mixed + "+/"), pick(43, mixed + "_-")])
        return made.upper() if draw.random() < 0.2 else made

    def assigned() -> str:
        name, sign, quote = draw.choice(["token", "secret", "api_key", "apikey", "password", "access_key", "client_secret"]), draw.choice([" = ", "=", ": ", ":"]), draw.choice(['"', "'", ""])
        made = f"{name}{sign}{quote}{key()}{quote}"
        return made.upper() if draw.random() < 0.2 else made

    local = lambda: draw.choice([f"({number(3)}) {number(3)}-{number(4)}", f"{number(3)}-{number(3)}-{number(4)}", f"{number(3)} {number(3)} {number(4)}"])
    person = lambda: f"{draw.choice('abcdef')}{draw.choice(['.', '_', ''])}{draw.choice([word(), number(2)])}"
    site = lambda: f"{draw.choice(['host', 'mail', 'shop'])}{number(1)}"
    ending = lambda: draw.choice(["com", "org", "net"])
    asked = lambda: draw.choice(["mail", "write to", "contact", "reach", ""])
    makers = [
        (True, lambda: f"{asked()} {person()} [at] {site()} [dot] {ending()}"),
        (True, lambda: f"{asked()} {person()}(at){site()}.{ending()}"),
        (True, lambda: f"{asked()} {person()} at {site()} dot {ending()}"),
        (True, lambda: f"{asked()} {person()} @ {site()} . {ending()}"),
        (False, lambda: f"was (at) {draw.choice(['home', 'noon'])}.the"),
        (False, lambda: f"{word()} @ {word()}. {word().title()}"),
        (True, lambda: ".".join(byte() for _ in range(4))),
        (False, lambda: f"version {draw.randrange(20)}.{draw.randrange(300, 999)}.{draw.randrange(50)}.{draw.randrange(50)}"),
        (False, lambda: f"{draw.choice('abc')}_{'.'.join(byte() for _ in range(4))}-rc"),
        (True, lambda: f"{draw.choice(['card', 'visa', 'pay with', ''])} {card(True)}"),
        (False, lambda: f"{draw.choice(['id', 'serial', 'hash'])} {card(False)}"),
        (False, lambda: f"{draw.choice(['id', 'key'])}={number(16)}"),
        (True, lambda: f"{draw.choice(['', 'call', 'tel'])} +{number(1)} ({number(3)}) {number(3)}-{number(4)} {draw.choice(['', '10.20.30.40', '7'])}"),
        (True, lambda: f"{draw.choice(['phone', 'call', 'tel', 'mobile'])} {local()}"),
        (False, lambda: f"{number(3)} {number(3)} {number(4)}"),
        (False, lambda: f"part-{number(3)}.{number(3)}.{number(4)}"),
        (True, assigned),
        (True, assigned),
        (True, lambda: f"Authorization: Bearer {key()}"),
        (False, lambda: f"{draw.choice(['commit', 'revision', 'sha256', 'checksum', 'etag'])} {pick(40, '0123456789abcdef')}"),
        (False, lambda: f"{word()}_{word()}_{number(2)}_{word()}_{word()}"),
        (False, lambda: f"{draw.choice(['see', 'from', 'id:', 'path ='])} /{word()}/{word()}/{number(4)}/{word()}-{number(2)}"),
        (False, lambda: f"{word()}-{number(4)}-{number(2)}-{number(2)}-{word()}-rc{number(1)}"),
    ]
    rows = []
    for _ in range(count):
        good, maker = draw.choice(makers)
        rows.append({"text": f"{fill()} {maker()} {fill()}", "good": int(good)})
    return rows


def _sampled(docs: DataFrame) -> DataFrame:
    """The distinct texts of the lowest hashes that may hold spans: hash, text."""
    hashed = id_and_text(docs).filter(_some()).select(F.xxhash64("text").alias("hash"), "text")
    lowest = hashed.select("hash").distinct().orderBy("hash").limit(SAMPLE_TEXTS)
    return hashed.join(F.broadcast(lowest), "hash", "left_semi").groupBy("hash").agg(F.first("text").alias("text"))


def _labelled(docs: DataFrame) -> tuple[list[tuple[list[float], int]], list[str]]:
    """Features and labels of proposals in documents that are base spans or fail their kind's check, and text before such spans."""
    plain = _sampled(docs).withColumn("_base", F.concat(*base_spans(F.col("text")).values()))
    found = plain.select("hash", "text", "_base", F.inline(proposals(F.col("text"))))
    meets = F.exists("_base", lambda q: (q["kind"] == F.col("kind")) & (q["begin"] < F.col("end")) & (F.col("begin") < q["end"]))
    own = F.substring(F.col("text"), F.col("begin") + 1, F.col("end") - F.col("begin"))
    fails = F.when(F.col("kind") == KINDS.index("ip"), ~octets(own)).when(F.col("kind") == KINDS.index("card"), ~_valid("card", F.regexp_replace(own, r"\.", " ")))
    label = F.when(meets, 1).when(F.coalesce(fails, F.lit(False)), 0)
    before = F.substring(F.col("text"), F.greatest(F.col("begin") - CONTEXT_CHARS, F.lit(0)) + 1, F.least("begin", F.lit(CONTEXT_CHARS)))
    words = F.trim(F.regexp_replace(before, r"[^\p{L}\s,.'-]|[\p{L}-]{16,}", ""))
    rows = found.select("hash", "begin", "kind", "features", label.alias("good"), words.alias("words")).filter("good IS NOT NULL")
    rank = F.row_number().over(Window.partitionBy("kind", "good").orderBy("hash", "begin"))
    kept = rows.withColumn("rank", rank).filter(F.col("rank") <= PER_LABEL).collect()
    kept.sort(key=lambda row: (row["rank"], row["kind"], row["good"]))
    return [(row["features"], row["good"]) for row in kept], [row["words"] for row in kept if row["words"]]


def labelled_proposals(docs: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Features and labels that the trees are fitted to, those of documents first."""
    rows, around = _labelled(docs)
    kinds = "array<struct<text: string, good: int>>"
    texts = docs.sparkSession.range(1).select(F.inline(F.from_json(F.lit(json.dumps(forms(around))), kinds)))
    made = texts.select("good", F.inline(proposals(F.col("text")))).select("good", "features").collect()
    rows += [(row["features"], row["good"]) for row in made]
    return np.array([features for features, _ in rows], dtype=float), np.array([good for _, good in rows], dtype=float)


def train(docs: DataFrame) -> boosted.Boosted:
    """Trees fitted to the labelled proposals."""
    features, good = labelled_proposals(docs)
    return boosted.fit(features, good, features[:, FEATURES.index("kind")], len(KINDS))


BASE_SPANS, ALL_SPANS, _MORE = "_base_spans", "_all_spans", "_more_spans"


def _some() -> Column:
    return F.rlike("text", F.lit(r"[0-9@]|[\[({] ?(?:at|AT)| (?:at|AT) [A-Za-z0-9-]+ (?:dot|DOT) "))


def with_spans(rows: DataFrame, model: boosted.Boosted) -> DataFrame:
    """The rows with the base spans and all spans of their text, in order of begin and kind.

    A text without a digit, an at sign or a spelt-out one has no spans and meets no pattern.
    """
    some = _some()
    ordered = lambda left, right: (
        F.when(left["begin"] != right["begin"], left["begin"] - right["begin"])
        .when(left["kind"] != right["kind"], left["kind"] - right["kind"])
        .otherwise(left["end"] - right["end"])
    )
    none = F.lit(None).cast(f"array<{SPAN}>")
    base = F.concat(*base_spans(F.col("text")).values())
    limit = lambda kind: F.element_at(F.array(*map(F.lit, model.thresholds)), kind + 1)
    rated = lambda p: boosted.expression(model, [p["features"][at] for at in range(len(FEATURES))]) >= limit(p["kind"])
    plain = lambda p: F.struct(p["begin"].alias("begin"), p["end"].alias("end"), p["kind"].alias("kind"))
    clash = lambda p, q: ((p["kind"] == q["kind"]) | (p["kind"] == SECRET)) & (p["begin"] < q["end"]) & (q["begin"] < p["end"])
    with_base = rows.withColumn(BASE_SPANS, F.when(some, F.array_sort(base, ordered)).otherwise(F.array().cast(f"array<{SPAN}>")))
    open_ = F.filter(proposals(F.col("text")), lambda p: ~F.exists(F.col(BASE_SPANS), lambda q: clash(p, q)))
    with_more = with_base.withColumn(_MORE, F.when(some, F.transform(F.filter(open_, rated), plain)).otherwise(none))
    add = lambda held, p: F.when(F.exists(held, lambda q: clash(p, q)), held).otherwise(F.concat(held, F.array(p)))
    every = F.array_sort(F.aggregate(F.array_sort(F.col(_MORE), ordered), F.col(BASE_SPANS), add), ordered)
    return with_more.withColumn(ALL_SPANS, F.when(F.size(_MORE) > 0, every).otherwise(F.col(BASE_SPANS))).drop(_MORE)


def listed(column: str) -> Column:
    """Spans as kind:begin:end, joined by commas."""
    names = F.array(*map(F.lit, KINDS))
    one = lambda s: F.concat_ws(":", F.element_at(names, s["kind"] + 1), s["begin"].cast("string"), s["end"].cast("string"))
    return F.array_join(F.transform(F.col(column), one), ",")


def redacted(text: str, column: str) -> Column:
    """The text with its spans replaced by their kind in square brackets; overlapping spans become one, of the first's kind."""
    names = F.array(*(F.lit(f"[{kind.upper()}]") for kind in KINDS))

    def step(state: Column, s: Column) -> Column:
        fresh = s["begin"] >= state["at"]
        gap = F.substring(F.col(text), state["at"] + 1, s["begin"] - state["at"])
        made = F.when(fresh, F.concat(state["made"], gap, F.element_at(names, s["kind"] + 1))).otherwise(state["made"])
        return F.struct(F.greatest(state["at"], s["end"]).alias("at"), made.alias("made"))

    rest = lambda state: F.concat(state["made"], F.substring(F.col(text), state["at"] + 1, F.length(F.col(text))))
    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("made"))
    return F.when(F.size(column) == 0, F.col(text)).otherwise(F.aggregate(F.col(column), start, step, rest))


def redact(docs: DataFrame) -> DataFrame:
    """The documents with the personal data in their text replaced; a null text stays null."""
    found = with_spans(docs, train(docs))
    return found.withColumn("text", redacted("text", ALL_SPANS)).drop(BASE_SPANS, ALL_SPANS)


def personal_data(docs: DataFrame) -> DataFrame:
    """Counts of base spans by kind, their digest, all spans of each document, and the number of these."""
    found = with_spans(id_and_text(docs), train(docs))
    of = lambda kind: F.size(F.filter(BASE_SPANS, lambda s: s["kind"] == KINDS.index(kind))).cast("long")
    counts = [of(kind).alias(f"n_{kind}") for kind in BASE]
    return found.select("doc_id", *counts, F.sha2(listed(BASE_SPANS), 256).alias("base_sha256"), listed(ALL_SPANS).alias("spans"), F.size(ALL_SPANS).cast("long").alias("n_spans"))

"""Small tables with the awkward rows that every text operator has to take."""

LONG = "lorem ipsum dolor sit amet " * 40_000


def awkward(spark, texts=(), extra=()):
    """Documents with null, empty, blank, very long and repeated texts, a null key, and columns named like results."""
    rows = [
        (1, None),
        (2, ""),
        (3, " \n\t "),
        (4, LONG),
        (5, "one two three four five six seven eight nine ten eleven"),
        (5, "one two three four five six seven eight nine ten eleven"),
        (6, "one two three four five six seven eight nine ten eleven"),
        (7, "ümläut 漢字 🙂 <|endoftext|> don't \x1c x"),
        (None, "no key at all"),
        *((100 + at, text) for at, text in enumerate(texts)),
        *extra,
    ]
    return spark.createDataFrame(
        [(key, text, "en", "src", len(text or ""), 0.5, [1], "x", 7) for key, text in rows],
        "doc_id long, text string, lang string, source string, n_chars long, score double, spans array<int>, n_words string, start int",
    ).repartition(3)


def rows_of(df):
    """Rows as plain dictionaries in a fixed order."""
    return sorted((row.asDict(recursive=True) for row in df.collect()), key=repr)


def by_key(df, key="doc_id"):
    """Rows by key; repeated keys must have equal rows."""
    found = {}
    for row in df.collect():
        values = row.asDict(recursive=True)
        assert found.setdefault(values[key], values) == values
    return found

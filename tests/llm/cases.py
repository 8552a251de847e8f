"""Small tables with the awkward cases every operator has to take."""

DOCS = "doc_id long, text string, lang string, source string, n_chars long, size int, chunk string, digest string, row string"


def awkward_rows():
    """Nulls, empty and very long texts, ties, repeated rows; the last columns have clashing names."""
    long = " ".join(f"w{i % 977}x{i % 13}" for i in range(60_000))
    texts = [
        (1, "Plain words in a row, nothing more."),
        (2, "Plain words in a row, nothing more."),
        (2, "Plain words in a row, nothing more."),
        (3, None),
        (4, ""),
        (5, " \t\n "),
        (6, long),
        (7, long + " end"),
        (8, "▁ odd <s> [INST] \x1f\x00 é 😀"),
        (9, "one"),
        (None, "a row without id"),
        (None, None),
        (10, "passage " + " ".join(f"p{i}" for i in range(60)) + " left"),
        (11, "other " + " ".join(f"p{i}" for i in range(60)) + " right"),
        (12, "plain words in a row, nothing more."),
    ]
    sources = ["a", "b", None, "a", "c"]
    return [
        (i, t, None if n % 3 else "en", sources[n % 5], None if t is None else len(t), n, "c", None, "r")
        for n, (i, t) in enumerate(texts)
    ]


def awkward(spark):
    return spark.createDataFrame(awkward_rows(), DOCS).repartition(3)


def empty(spark):
    return spark.createDataFrame([], DOCS)


def docs_of(spark, texts, source="s"):
    rows = [(i, t, "en", source, len(t or "")) for i, t in enumerate(texts)]
    return spark.createDataFrame(
        rows, "doc_id long, text string, lang string, source string, n_chars long"
    )

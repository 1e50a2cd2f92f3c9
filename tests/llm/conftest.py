import pytest

# Columns that the operators must not trip over: names they use inside.
CLASHING = ("kept", "size", "n_words", "label", "bucket", "key", "row", "part", "score", "_hash", "set_key", "n")


@pytest.fixture(scope="session")
def make_docs(spark):
    """Documents from (doc_id, text, lang, source) rows, with further columns whose names clash."""

    def make(rows, partitions=3):
        full = [(*r, *[None] * (4 - len(r)), *[k for k, _ in enumerate(CLASHING)]) for r in rows]
        kinds = "doc_id long, text string, lang string, source string, " + ", ".join(f"{c} int" for c in CLASHING)
        return spark.createDataFrame(full, kinds).repartition(partitions)

    return make


@pytest.fixture(scope="session")
def odd_rows():
    """Nulls in every column, empty and blank texts, a very long text, ties and repeated rows."""
    words = [f"w{k * k % 977}" for k in range(60_000)]
    return [
        (1, "One two three four five six seven.\nA b c\nd e f\ng h i", "en", "s1"),
        (1, "One two three four five six seven.\nA b c\nd e f\ng h i", "en", "s1"),
        (2, "ONE two three four five six seven.\nA b c\nd e f\ng h i", "en", "s2"),
        (3, None, None, None), (4, "", "de", "s1"), (5, " \t\n\x0b ", "en", None),
        (None, "One two three four five six seven.\nA b c\nd e f\ng h i", None, "s1"),
        (None, None, None, None), (6, "été Ünï \u00a0 word", "fr", "s3"), (7, "single", "en", "s1"),
        (8, " ".join(words), "en", "s2"), (9, "\n".join(words[:3000]), "en", "s2"), (7, "single", "en", "s1"),
        (10, "12 34 !!", "en", "s1"), (11, "<|endoftext|> said 'it's'   here\n\n", "en", "s1"),
    ]

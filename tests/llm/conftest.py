import pytest


@pytest.fixture(scope="session")
def documents(spark):
    """Texts with every odd case: null, empty, blank, short, repeated, long, odd characters, null id, extra columns."""
    long_text = " ".join(f"word{k} of a long text" for k in range(3_000))
    passage = " ".join(f"token{k}" for k in range(60))
    rows = [
        (0, "The quick brown fox jumps over the lazy dog and runs far away from here today\nshort line"),
        (1, "The quick brown fox jumps over the lazy dog and runs far away from here today\nshort line"),
        (2, None),
        (3, ""),
        (4, "   \n\t "),
        (5, "don't stop: 12345 naïve café — “quoted” ＦＵＬＬ 漢字 é ΑΣ İ \x1c <|endoftext|> <|startoftext|>"),
        (6, long_text),
        (7, passage + "\nown words of seven"),
        (8, "own words of eight\n" + passage),
        (9, long_text),
        (None, passage),
        (12, "a"),
        (13, "aaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaa"),
        (14, "baaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaab"),
        (12, "a"),
    ]
    clash = [(i, t, "en", "src", None, 1, 2, "x", 4, 5, 6) for i, t in rows]
    return spark.createDataFrame(
        clash,
        "doc_id long, text string, lang string, source string, n_chars long, node long, key long, line string, n long, "
        "component long, bucket int",
    )


@pytest.fixture(scope="session")
def no_documents(documents):
    return documents.limit(0)

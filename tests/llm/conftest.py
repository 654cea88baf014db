import pytest

from hitparade.llm.workers import reach

COLUMNS = "doc_id long, text string, lang string, source string, n_chars long"
#: Names that the operators use themselves.
CLASHING = "row string, spans string, words string, kept string, node string, length int, component_id string, n_words int"


@pytest.fixture(autouse=True)
def reachable(spark):
    reach(spark)


@pytest.fixture(scope="session")
def documents(spark):
    """A documents table of (doc_id, text), with columns whose names clash."""

    def build(rows, clashing=True):
        full = [(i, t, "en", "s", None if t is None else len(t)) for i, t in rows]
        if not clashing:
            return spark.createDataFrame(full, COLUMNS)
        return spark.createDataFrame([(*r, "a", "b", "c", "d", "e", 1, "f", 2) for r in full], f"{COLUMNS}, {CLASHING}")

    return build


@pytest.fixture(scope="session")
def edge_rows():
    """Nulls, empty and blank texts, ties, repeated rows, odd characters, and a long text."""
    long = " ".join(f"w{i % 977}x{i}" for i in range(30_000))
    passage = " ".join(f"p{i}" for i in range(70))
    base = [f"b{i}" for i in range(200)]
    near = [*base[:190], *(f"c{i}" for i in range(10))]
    return [
        (1, "one two three"),
        (2, None),
        (3, ""),
        (4, " \n\t "),
        (None, "no id at all " * 8),
        (None, None),
        (5, long),
        (6, long),
        (7, " ".join(base)),
        (7, " ".join(base)),
        (8, " ".join(near)),
        (9, f"start {passage} end"),
        (10, f"other {passage} tail and more"),
        (11, f"{passage} {passage}"),
        (12, "İstanbul ΣΑΣ ǅ  nbsp 日本語 😀 é́ a\x1cb <|endoftext|> I'll x" * 3),
        (13, "ONE two THREE"),
        (14, "word\r\nword\x0bword  double  space "),
        (15, "line of some words\n" * 40),
    ]

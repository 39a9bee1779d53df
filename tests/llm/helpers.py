"""Frames of difficult rows for the text operators."""

DOCS = ("doc_id long, text string, lang string, source string, n_chars long, id string, norm string, sha string, print string, "
        "`__hit` string, `__word` string, `__id` string, spans string, ctx string, size string, term string, kept string")

LONG = "the quick brown fox jumps over the lazy dog and runs away " * 4000
PASSAGE = " ".join(f"alpha{i} beta{i} gamma{i}" for i in range(40))


def rows():
    texts = [None, "", "  \t ", "...!?", LONG, LONG, PASSAGE, "before " + PASSAGE + " after it all", PASSAGE.upper(),
             "a  b\tc", "a b c", "a b\nc ", "mail me: jane.doe@example.org or +49 30 1234567", "été \U0001f600 漢字", "x" * 30000]
    out = [(i, t, "en" if i % 2 else None, "s") for i, t in enumerate(texts)]
    out += [(20, "a b c", "en", "s"), (20, "a b c", "en", "s"), (None, "null id", "de", "s"), (None, None, None, None)]
    return [(a, b, c, d, None, *["clash"] * 12) for a, b, c, d in out]


def edge_docs(spark):
    return spark.createDataFrame(rows(), DOCS)


def no_docs(spark):
    return spark.createDataFrame([], DOCS)


def plain(spark, texts, first=0):
    return spark.createDataFrame([(i + first, t) for i, t in enumerate(texts)], "doc_id long, text string")

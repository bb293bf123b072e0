"""Small frames with the awkward rows that every operator must bear."""

SF = "/root/testdata/sf0.001"
#: Names that operators give to columns of their own.
CLASHES = ["found", "spans", "base", "_kinds", "n_tokens", "leaf_chars", "text_key", "__bytes", "w", "pairs", "runs", "copies"]
DOC = "doc_id long, text string, lang string, source string, n_chars long"


def docs(spark, rows):
    """Rows of (doc_id, text[, lang[, source]]), with columns whose names could clash with an operator's own."""
    full = [(r[0], r[1], r[2] if len(r) > 2 else "en", r[3] if len(r) > 3 else "s", len(r[1]) if r[1] else 0, 1, 2, "x", *CLASHES) for r in rows]
    return spark.createDataFrame(full, DOC + ", id long, key long, fp string, " + ", ".join(f"`{c}` string" for c in CLASHES))


def table(spark, name):
    return spark.read.parquet(f"{SF}/{name}.parquet")


AWKWARD = [(1, None), (2, ""), (3, " \t\n"), (4, "word"), (4, "word"), (None, "word two three four"), (5, "ünïcödé ß 漢字 \U0001f600 text"), (6, "a" * 50_000), (7, "w " * 30_000), (8, "\x00 zero & <tag> [x]")]

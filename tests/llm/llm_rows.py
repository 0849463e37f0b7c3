"""Rows of documents for the tests of this folder."""

#: Columns of documents, and more columns whose names clash with names that operators use inside.
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, size long, fp long, row_id string, y int, score double"


def document(id, text, source="s0"):
    return (id, text, "en", source, len(text or ""), 7, 7, "r", 7, 0.5)

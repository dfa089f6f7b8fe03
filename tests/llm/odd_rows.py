"""A table with everything that an operator must stand."""

DOCS = "doc_id long, text string, lang string, source string"
LONG = " ".join(f"word{i % 977} x{i}" for i in range(30_000))
# Ids repeat, ids, texts, languages and sources are null, texts are empty, blank, long, multi-byte.
ROWS = [
    (1, "The cat sat on the mat. The cat sat on the mat.", "en", "a"), (2, "", "en", "a"), (3, None, "en", None),
    (None, "the CAT sat on the mat. The cat sat on the mat.", None, "b"), (None, None, None, None),
    (4, "\n \t\n", "de", "b"), (5, LONG, "en", "b"), (6, LONG.upper(), "en", "b"), (7, "日本語 テキスト é́ \U0001f600 ñ", "es", "c"),
    (7, "日本語 テキスト é́ \U0001f600 ñ", "es", "c"), (7, "another text under the same id", "es", "c"), (8, "12345 !!! ###", None, "c"),
    (9, "<|endoftext|>it's we'll  <|endoftext|>\n\n x", "fr", "c"),
]

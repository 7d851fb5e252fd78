"""Rows that every operator on documents must take."""
EDGE = [(1, None), (2, ""), (3, " \n\t"), (None, "some words here"), (4, "some words here"), (4, "some words here"),
        (5, "x" * 200_000), (6, "word " * 40_000), (7, "ünïcödé 日本語 text 🙂"), (8, "a\nb\n\na")]

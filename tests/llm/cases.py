"""Rows that every operator must handle."""

#: Nulls, empty and blank texts, repeated rows, equal texts of different case, a very long text.
ODD = [
    (None, None), (None, "no id"), (None, "no id"), (1, None), (2, ""), (3, " \n\t "), (4, "One two three"), (5, "one TWO three"),
    (5, "one TWO three"), (6, "é ünïcode 日本語 " * 40), (7, "long " * 30_000), (8, "x" * 50_000),
]

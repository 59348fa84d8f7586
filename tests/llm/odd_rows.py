"""Rows that every operator must take."""

LONG = " ".join(f"w{i % 5000}" for i in range(60_000))

#: Null, empty, blank, very long, repeated rows, ties, non-ASCII and no spaces at all.
ODD = [
    (None, "a null id stands here with ten words or a few more"),
    (1, None),
    (2, ""),
    (3, " \t\n\x0b\x0c\r "),
    (4, LONG),
    (5, "same words in two documents are a tie of some kind here"),
    (6, "same words in two documents are a tie of some kind here"),
    (7, "the very same row twice"),
    (7, "the very same row twice"),
    (8, "é" * 30_000),
    (9, "UPPER lower Ünïcödé 中文 𐍈 \x00 end"),
    (10, "one"),
    (11, "\n\n\n"),
]

"""Rows that every operator must bear: NULLs, empty texts, repeated rows, unusual characters."""

ODD = [
    (1, None), (2, ""), (3, " \n\t\n"), (4, "one"), (None, "no id at all here"), (None, None),
    (5, "alike"), (5, "alike"), (6, "ümlaut 漢字 \U0001f600 \x00 end"),
]

"""Small hand-made documents."""

PROSE = (
    "The house on the hill was old and the garden behind it had not been touched for years. "
    "In the spring a family came to look at it, and they liked the view of the river so much that "
    "they bought it the same day. The children ran from room to room while the parents talked with "
    "the neighbours about the roof, which was said to be in need of repair before the next winter. "
)
# Extra columns whose names the operators use inside.
DOC_DDL = (
    "doc_id BIGINT, text STRING, lang STRING, source STRING, n_chars BIGINT, row STRING, size INT, h STRING, "
    "block STRING, words STRING, q_words STRING, fp STRING, rank STRING, length STRING, kept STRING, m_out STRING"
)


def doc(i, text, source="a"):
    return (i, text, "en", source, None if text is None else len(text), *["x"] * 1, 1, *["x"] * 9)


ODD = [
    doc(1, None),
    doc(2, ""),
    doc(3, " \t\n"),
    doc(4, "one"),
    doc(5, PROSE + " token: abcdefghijklmnop0123 end"),
    doc(5, PROSE + " token: abcdefghijklmnop0123 end"),  # a repeated row
    doc(6, PROSE, None),
    doc(None, PROSE, "b"),
    doc(None, None, None),
    doc(7, (PROSE + "Ünïcödé \U0001f600 text. ") * 2000, "b"),
    doc(8, "Licensed under the Apache License, Version 2.0.", "\U00010400"),
    doc(9, "Ha " * 3000, "￮"),
    doc(10, "<|endoftext|> a  b c\x1cd́ Σ", ""),
]


def sorted_rows(rows):
    return sorted((tuple(r) for r in rows), key=lambda t: tuple((v is None, str(v)) for v in t))

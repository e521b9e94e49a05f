"""Rows that every operator over documents has to get through."""

LONG = "\n".join(f"line {k} of a very long text" for k in range(20_000))

AWKWARD = [
    (1, "a b c d e f\nsecond line\nthird line\nlast", "s"), (1, "a b c d e f\nsecond line\nthird line\nlast", "s"),
    (2, None, "s"), (3, "", None), (4, "   \n\t ", "t"), (None, "no id\nat all\nhere", "t"), (5, LONG, None),
    (6, "a b c d e f\nsecond line\nthird line\nlast", None), (7, "word", "u"),
]

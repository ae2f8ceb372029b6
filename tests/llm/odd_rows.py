"""Rows that every operator on documents must take."""

LONG = "so it goes on and on with words that nobody reads " * 4000

#: Nulls, empty texts, ties, repeated rows, a very long text; ids repeat and are null.
ODD_ROWS = [
    (1, "the quick brown fox jumps over the lazy dog and runs away from it all"),
    (2, "THE quick brown fox jumps over the lazy dog and runs away from it all"),
    (2, "THE quick brown fox jumps over the lazy dog and runs away from it all"),
    (3, None), (4, ""), (5, " \n\t "), (None, "no id here at all but some words"), (None, None),
    (6, "no id here at all but some words"), (7, "one"), (7, "One"), (8, "naïve café ΑΒΓ ß İ ſ 日本 😀"),
    (9, LONG), (10, LONG.upper()), (11, "a b"), (-3, "A  B"),
]

"""Texts every operator must handle."""

LONG = "alpha beta gamma delta epsilon zeta eta theta " * 3000
ODD = [
    (1, None), (2, ""), (3, "   \n\t "), (4, "word"), (5, "ümlaut ÄÖ 　 wide space 好的 é"), (6, "a\n\nb\n"),
    (7, LONG), (8, LONG), (9, "x" * 20_000), (10, "é" * 9_000), (11, "<|endoftext|> a <|startoftext|>b"), (12, "tie tie tie tie tie tie"),
]


def clashing(df):
    """The table with extra columns whose names operators use inside."""
    from pyspark.sql import functions as F

    names = ("key", "text_", "score", "fp", "node", "component", "w", "n", "label", "line", "ids", "decoded", "contaminated")
    return df.withColumns({c: F.lit(c) for c in names})

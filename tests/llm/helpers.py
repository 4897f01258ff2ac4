"""Small tables with the awkward rows every operator must take."""

from __future__ import annotations

import random

CLASHES = ["id", "norm", "key", "row", "block", "h", "line_no", "digest", "kept_text", "keep_id", "label", "votes", "in_0", "file", "html_"]


def words(seed: int, n: int) -> list[str]:
    r = random.Random(seed)
    parts = ["an", "the", "ther", "ing", "ou", "éa", "ß", "st", "re", "ha"]
    return ["".join(r.choice(parts) for _ in range(r.randint(1, 4))) for _ in range(n)]


def prose(seed: int, n: int) -> str:
    return " ".join(words(seed, n))


def awkward_texts() -> list[tuple]:
    long = "\n".join(prose(k, 40) for k in range(900))
    base = prose(1, 120)
    return [
        (1, base), (2, base), (3, base.replace(" ", "  \t")), (4, None), (5, ""), (5, ""), (6, " \n\t\x0b "),
        (7, long), (8, long + " tail"), (9, "one line that repeats often\nsecond\n" + prose(2, 30)),
        (10, "ONE line that repeats often  \n" + prose(3, 30) + "\none line that repeats often"), (10, "same id, other text"),
        (None, base), (None, "no id here\none line that repeats often"), (None, None),
        (11, base + " changed"), (12, "x"), (13, "a b c d"), (14, "퟿ \U0001F600    ’s İ"), (15, "1\r\n2\x00 \x1c3"),
        (16, "w" * 40_000), (17, "<s>[INST] </s> <|endoftext|> </w>"),
    ]


def docs_table(spark, rows=None):
    """documents with extra columns whose names operators might use."""
    rows = awkward_texts() if rows is None else rows
    extra = ", ".join(f"`{c}` string" for c in CLASHES)
    return spark.createDataFrame([(i, t, *["x"] * len(CLASHES)) for i, t in rows], f"doc_id long, text string, {extra}")


def rows_of(df, *cols):
    return sorted((tuple(r) for r in df.select(*cols).collect()), key=repr)

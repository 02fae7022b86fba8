"""Hand-made documents with every awkward case, and the pipeline's own way to write words."""

import random

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, kept string, score string, n_lines string, zp_row string"


def prose(n: int, seed: int) -> str:
    rnd = random.Random(seed)
    made = ["".join(rnd.choice("abdefgilmnoprstu") for _ in range(rnd.randint(2, 8))) for _ in range(400)]
    return " ".join(rnd.choice(made) + rnd.choice(["", "", "", ",", "."]) for _ in range(n))


def rows() -> list[tuple]:
    base = prose(200, 1)
    shared = "This line of twelve tokens is the same in many of the documents"
    texts = [
        (1, base), (2, base), (2, base), (3, base + " one more word"), (4, None), (5, ""), (6, " \t\n\x0b "), (7, "word"), (8, "word"),
        (9, "A b\nA B\n" + shared), (10, shared + "\n" + prose(80, 2)), (11, prose(60, 3) + "\n" + shared), (12, "\n".join([shared] * 3)),
        (13, "Version 12 of the file was made on 2024-01-02 by build 77 here now\nx"), (14, "Version 13 of the file was made on 2025-03-04 by build 78 here now\ny"),
        (15, "Version 14 of the file was made on 2026-05-06 by build 79 here now\nz"), (16, prose(20_000, 4)), (17, "a" * 30_000),
        (18, "éàü ñ 日本語 🙂 \0 <|endoftext|>  two  spaces \r\n tab\tend "), (None, base), (None, None), (19, "!!! ??? ### $$$ " * 40),
        (20, "one two three four five six " * 30), (21, "ONE two three four five six " * 30),
    ]
    return [(i, t, [None, "en", "de", ""][k % 4], [None, "web"][k % 2], 0, "x", "y", "z", "w") for k, (i, t) in enumerate(texts)]


def docs(spark, some: list[tuple] | None = None):
    return spark.createDataFrame(rows() if some is None else some, SCHEMA)

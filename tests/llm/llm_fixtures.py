"""Small documents with every awkward case: NULLs, empty and long texts, ties, repeated rows, clashing columns."""

from __future__ import annotations

import random

LINES = [f"{a} {b} walks over the {c} hill and back." for a in ("Ann", "Bo", "Cy") for b in "xyz" for c in ("red", "old")]


def texts() -> list[str | None]:
    pick = random.Random(7)
    base = ["\n".join(pick.choices(LINES, k=9)) for _ in range(6)]
    prose = [" ".join(pick.choices("lorem ipsum dolor sit amet élan öde ñandú 42 it's".split(), k=80)) for _ in range(4)]
    shared = "This passage of more than fifty bytes stands in several documents, word for word, again."
    return [
        *base,
        base[0],  # an exact copy
        base[1] + "\nOne more line.",
        None,
        "",
        " \n\t ",
        "a",
        *prose,
        prose[0] + " " + shared,
        shared + " " + prose[1],
        "x" * 3000,
        "ab" * 2000 + shared,
        "words and words " * 2500,  # very long
        "She said 'tis don't we're  two  blanks\r\n\r\n  end ",
        "日本語のテキスト ümläut é combining   nbsp   sep Σ İ <|endoftext|>",
        "control \x1c\x1d\x85 signs",
    ]


def documents(spark, extra: str = ""):
    """(doc_id, text, block, score, row) with a NULL id and rows that repeat; the last three clash with inner names."""
    rows = [(i, text, "kept", 1.5, i) for i, text in enumerate(texts())]
    rows += [rows[0], (None, rows[2][1], None, None, None), (rows[3][0], "another text of the same id", "z", 0.0, 1)]
    return spark.createDataFrame(rows, "doc_id long, text string, block string, score double, row int").repartition(3)


def empty(spark):
    return documents(spark).limit(0)

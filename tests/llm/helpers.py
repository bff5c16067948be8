"""Small tables for the tests of the operators for training text."""

from __future__ import annotations

import random

#: Columns beside those asked for, with names that operators might use inside.
CLASHING = "points int, bare string, n int, bucket int, gone_id int, times int, time string, rank int"
EXTRA = (1, "x", 2, 3, 4, 5, "y", 6)

WORDS = "alder birch cedar elm fir gum hazel ivy juniper larch maple oak pine rowan spruce tamarack willow yew".split()


def documents(spark, rows):
    """rows: (doc_id, text[, lang, source]); a table like documents with more columns."""
    full = [(*r, *("en", "src1")[len(r) - 2 :], len(r[1] or ""), *EXTRA) for r in rows]
    return spark.createDataFrame(full, f"doc_id bigint, text string, lang string, source string, n_chars bigint, {CLASHING}")


def prose(seed: int, words: int) -> str:
    r = random.Random(seed)
    return " ".join(r.choice(WORDS) + r.choice(["", "", "a", "er", "ing"]) + str(r.randrange(30)) for _ in range(words))


def changed(text: str, seed: int, times: int) -> str:
    r = random.Random(seed)
    words = text.split(" ")
    for _ in range(times):
        words[r.randrange(len(words))] = f"other{r.randrange(10**6)}"
    return " ".join(words)


def rows_of(df):
    return [r.asDict() for r in df.collect()]

"""Small tables with the awkward cases: nulls, empty and long texts, repeats, clashing columns."""

import random

SYLLABLES = "ba ce di fo gu ha ke li mo nu pa re si to vu".split()


def prose(seed: int, words: int) -> str:
    source = random.Random(seed)
    return " ".join("".join(source.choices(SYLLABLES, k=source.randint(1, 4))) for _ in range(words))


def documents(spark, rows):
    """(doc_id, text) with columns beside that are named like inner ones."""
    table = [(i, t, "x", 1, 2, "n") for i, t in rows]
    return spark.createDataFrame(
        table, "doc_id bigint, text string, node string, id int, key int, n_chars string"
    )


def awkward():
    return [(1, None), (2, ""), (3, " \n\t"), (4, "a"), (4, "a"), (None, "null id text"), (5, "é\n\nword " * 4000), (6, "...!")]

"""Documents with the cases every operator must bear."""

import random

SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long, kept string, score string, "
          "n_words string, text_hash string, h string, part string, lines string, n_lines string, th string")
WORDS = "the of and to in that is was for with on as by it at from this have are not".split()


def prose(seed, n, words=WORDS):
    r = random.Random(seed)
    return " ".join("".join(r.choice(words) for _ in range(r.randint(1, 2))) for _ in range(n))


def frame(spark, rows):
    """``rows``: (doc_id, text[, lang]); the other columns clash with names used inside."""
    data = [(r[0], r[1], r[2] if len(r) > 2 else "en", "s", len(r[1] or "")) + ("x",) * 9 for r in rows]
    return spark.createDataFrame(data, SCHEMA)


EDGE = [(1, None), (2, ""), (3, " \n\t "), (4, "one"), (5, "one"), (5, "one"), (None, "no id at all"), (None, None),
        (6, "é中文 naïve <|endoftext|> \\### </turn>"), (7, prose(7, 60_000)), (8, "a" * 200_000), (9, prose(9, 40)),
        (10, prose(9, 40)), (-3, "negative id\nwith lines\n\nnegative id"), (11, None, None), (12, "text without language", None)]

"""A small table with every awkward case: nulls, empty and long texts, ties, repeated rows, clashing columns."""

import random

from pyspark.sql import types as T

CLASHING = ["row", "shard", "slot", "size", "score", "kept", "node", "fp", "part", "data", "n_lines", "length", "rank", "lang_pred"]
SCHEMA = T.StructType(
    [T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
     T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType())]
    + [T.StructField(c, T.StringType()) for c in CLASHING])


def edge_texts() -> list[tuple[int | None, str | None]]:
    rng = random.Random(5)
    words = ["the", "and", "Über", "ñandú", "naïve", "x1", "東京", "🙂", "end.", "of,"]
    long = " ".join(rng.choice(words) + str(rng.randrange(9)) for _ in range(60_000))
    prose = [" ".join(rng.choice(words) for _ in range(rng.randrange(1, 90))) for _ in range(25)]
    rows: list[tuple[int | None, str | None]] = [
        (None, None), (None, "same text"), (None, "same text"), (7, None), (8, ""), (9, " \t\r\n \x0b\x0c"), (10, "\n\n\n"),
        (11, "same text"), (11, "same text"), (11, "other text of the same id"), (12, "SAME TEXT"), (13, "\x1c odd\x1dspace \x85 here　too"),
        (14, long), (15, long), (16, "é combining ́ alone"), (17, "can't <|endoftext|> don't"), (18, "a\nb\nA \n b\t\n\nc"),
        (19, "no letters 123 456"[11:]), (-5, "negative id"), (2**62, "large id"), (20, "one"), (21, "one two"), (22, "a  b   c\n\n d"),
    ]
    rows += [(100 + i, t) for i, t in enumerate(prose)]
    rows += [(200 + i, "shared line here\n" + prose[i % 25] + "\n  Shared LINE here\t") for i in range(14)]
    return rows


def edge_docs(spark):
    rows = [(i, t, [None, "en", "de"][k % 3], [None, "s1", "s2"][k % 3], None if t is None else len(t), *CLASHING)
            for k, (i, t) in enumerate(edge_texts())]
    return spark.createDataFrame(rows, SCHEMA).repartition(5)


def empty_docs(spark):
    return spark.createDataFrame([], SCHEMA)

"""Documents that try an operator's limits: nulls in every column, empty and very long texts, ties,
repeated rows, no rows, and extra columns whose names operators use themselves."""

import random

SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long, "
          "size long, shard int, spans string, ids string, detected string, token string, cls string, "
          "n int, key string, place long, digest string, row_index long, range_no int, perplexity double")
EXTRA = (7, 7, "x", "y", "z", "t", "c", 7, "k", 7, "d", 7, 7, 0.5)


def row(doc_id, text, lang="en", source="s"):
    return (doc_id, text, lang, source, None if text is None else len(text), *EXTRA)


def edge_rows():
    rng = random.Random(5)
    words = ["the", "of", "river", "stone", "and", "light", "glass", "to", "winter", "field"]
    prose = lambda n: " ".join(rng.choice(words) + rng.choice(["", "", "s", "er"]) for _ in range(n))
    base = prose(200)
    rows = [row(1, base), row(1, base), row(2, base), row(3, None, None, None), row(None, prose(30)), row(4, ""),
            row(5, "   \n\t "), row(6, prose(30000)), row(7, "x" * 200000), row(8, "ß", "de", None), row(9, "&&& !!"),
            row(10, base + " tail"), row(11, " nbsp é😀 the river"), row(12, "Hallo Welt", None, "t")]
    rows += [row(20 + k, prose(40 + k), rng.choice(["en", "de"]), rng.choice(["s", "t", "\U0001f600", "ü"])) for k in range(12)]
    return [r[:5] + EXTRA for r in rows]


def edge_docs(spark):
    return spark.createDataFrame(edge_rows(), SCHEMA)


def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)

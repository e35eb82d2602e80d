"""Rows that every operator on texts must take: nulls, empty and long texts, repeats, clashing columns."""

LONG = " ".join(f"long{i % 977} word{i % 31}, and." for i in range(12_000))
EDGE = [
    (0, None), (1, ""), (2, " \n\t "), (3, "one"), (4, "a b c d"), (5, LONG), (5, LONG), (6, "Ünï cødé 漢字 \x1c\x85 <|endoftext|> text"),
    (7, "same words here again " * 30), (8, "same words here again " * 30), (None, "a row without an id"), (9, "x" * 50_000), (None, None),
]
SHAPE = "doc_id long, text string, lang string, source string, n_chars long, score double, id long, node long, bucket long, label int, text_hash long, n_tokens long, component long"


def edge_docs(spark, rows=EDGE):
    extra = ("en", "s", 0, 0.5, 1, 1, 1, 1, 1, 1, 1)
    return spark.createDataFrame([(i, t, *extra) for i, t in rows], SHAPE)

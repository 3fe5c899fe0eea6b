"""Small tables with all that can be odd about one."""

LONG = " ".join(f"wort{k % 977} the and satz{k % 31}." for k in range(6000))

DOCUMENTS = [
    (1, "The cat and the dog went to the house of the old man in the town by the sea.", "en"),
    (2, None, "en"),
    (3, "", None),
    (4, "The cat and the dog went to the house of the old man in the town by the sea.", "en"),
    (5, LONG, "de"),
    (5, LONG, "de"),
    (None, "no id here but a text of some words", None),
    (7, " \t\n ", "en"),
    (8, "12 345 !!! ###", None),
    (9, "Größe 你好 \U0001d4b3 é \x00 a b  c", "de"),
    (10, "x", "en"),
    (11, "one  two\n\nthree four  five", "en"),
    (-12, "</s>[INST] ok [/INST] <|endoftext|> \\ back", "en"),
    (13, "The cat and the dog went to the house of the old man in the town by the lake.", "en"),
]

#: Columns whose names operators use for themselves.
CLASH = ["score", "start", "length", "fp", "copy", "dest", "tie", "predicted", "spans", "lang_pred", "n_chars", "__place", "source"]


def documents(spark, rows=None):
    """The table above, with columns of clashing names and other types."""
    rows = DOCUMENTS if rows is None else rows
    schema = "doc_id long, text string, lang string, " + ", ".join(f"`{c}` array<string>" for c in CLASH)
    return spark.createDataFrame([(*r, *[["kept", c] for c in CLASH]) for r in rows], schema)


def key(row):
    return tuple((v is not None, v) for v in row)

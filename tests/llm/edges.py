"""Small awkward tables shared by the operators' tests."""

from __future__ import annotations

COLUMNS = "doc_id bigint, text string, lang string, source string, n_chars bigint"
# Names that the operators use for results or inside.
CLASHING = (
    "id", "row", "h", "n", "c", "token", "size", "score", "kept", "keep_id", "group_size", "text_sha256", "rid", "u",
    "taken", "target", "offset", "spans", "base", "owner", "hash", "bucket", "key", "tail", "root", "component_id",
    "start", "length", "ids", "salt", "norm", "head", "place", "epoch",
)

LONG = " ".join(f"word{i % 977}" for i in range(60_000))
ROWS = [
    (1, None, None, None, None),
    (2, "", "en", "a", 0),
    (3, "  \n\t ", "en", "a", 5),
    (4, "Only three words", "en", "a", 16),
    (5, "only THREE words", "en", "b", 16),
    (5, "only THREE words", "en", "b", 16),
    (6, LONG, "en", "b", len(LONG)),
    (7, LONG + " more", "en", None, None),
    (8, "é ß 日本 😀 " * 30, "de", "c", None),
    (9, "É ß 日本 😀 " * 30, "de", "c", None),
    (None, "a row that has no id at all here", "en", "a", 1),
]


def frame(spark, rows=ROWS):
    return spark.createDataFrame(rows, COLUMNS)


def clashing(df):
    """The frame with a further column for every name an operator may use itself."""
    taken = {name.lower() for name in df.columns}
    return df.selectExpr("*", *[f"'{name}' AS `{name}`" for name in CLASHING if name not in taken])


def sorted_rows(df):
    return sorted((tuple(row) for row in df.collect()), key=repr)

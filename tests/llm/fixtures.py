"""A small table with the cases every operator has to bear."""

from __future__ import annotations

LONG = " ".join(f"word{i % 977}" for i in range(30_000))
COPY = "The quick brown fox jumps over the lazy dog near the old stone bridge at dawn."
NEAR = COPY + " again"
PASSAGE = (
    "Alpha beta gamma delta epsilon. Zeta eta theta iota kappa lambda mu, nu xi omicron pi rho sigma tau. "
    "Upsilon phi chi psi omega, one two three four five six seven eight nine ten eleven twelve. "
    "Red green blue white black yellow orange purple brown pink grey cyan magenta lime teal navy."
)
TEXTS = {
    1: COPY,
    2: COPY,
    3: NEAR,
    4: None,
    5: "",
    6: " \n\t ",
    7: "one two",
    8: "ONE two",
    9: LONG,
    10: f"Some words come first here {PASSAGE} and others follow.",
    11: f"Elsewhere it is told otherwise {PASSAGE} with another end.",
    12: "Ünï cödé — “quotes” … <|endoftext|> don't  spaces wide 12345 !!! \x1c 😀",
    13: "0123 abc;def",
}


def documents(spark, texts=None, extra=True):
    """The table, with a repeated row, a null id and columns whose names operators also use."""
    rows = [(i, t, "en", "s", len(t or "")) for i, t in (texts or TEXTS).items()]
    rows += [(1, COPY, "en", "s", len(COPY)), (None, COPY, None, None, None)]
    schema = "doc_id BIGINT, text STRING, lang STRING, source STRING, n_chars BIGINT"
    docs = spark.createDataFrame(rows, schema)
    if extra:
        for name in ("score", "predicted", "n_words", "spans", "items", "ids", "class", "root", "hash", "n_removed"):
            docs = docs.selectExpr("*", f"'x' AS {name}")
    return docs


def empty(spark):
    return documents(spark).where("false")

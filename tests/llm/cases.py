"""Documents with everything that operators must bear: nulls, repeats, long texts, odd columns."""

DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long, {extra} string"
# Names that the operators use for columns of their own.
CLASHING = ("class_id", "_row", "n_removed", "toxic", "hash", "start", "_part", "content", "key")


def documents(spark, rows, extra="note"):
    """Documents out of ``(doc_id, text)`` with one more column."""
    full = [(i, t, "en", "s", None if t is None else len(t), "x") for i, t in rows]
    return spark.createDataFrame(full, DOCUMENTS.format(extra=extra))


def odd_rows():
    long = " ".join(f"word{i % 997} more{i}" for i in range(20_000))
    return [
        (1, "One two three four five six seven eight.\nNine ten.\nEleven twelve."),
        (1, "One two three four five six seven eight.\nNine ten.\nEleven twelve."),
        (2, "One two three four five six seven eight.\nNine ten.\nEleven twelve."),
        (3, None),
        (4, ""),
        (5, " \t\n\x0b"),
        (6, long),
        (7, long + " end"),
        (None, "a row without an id"),
        (None, None),
        (8, "🙂 é é ​ ß İ"),
    ]

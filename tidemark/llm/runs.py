"""Runs of consecutive parts of a text (lines, sentences) that repeat over all documents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import stored


def with_row(documents: DataFrame) -> DataFrame:
    """``doc_id, text, _row`` and all columns as ``_all``, whatever their names are.

    ``_row`` and ``doc_id`` together tell rows apart that share an id.
    """
    return documents.select(
        F.struct(*documents.columns).alias("_all"), "doc_id", "text", F.xxhash64("text").alias("_row")
    )


def later_runs(parts: DataFrame, size: int, counts: Column | None = None) -> DataFrame:
    """``doc_id, _row, at``: every run of ``size`` parts that has an earlier occurrence.

    ``parts`` has ``doc_id, _row, parts`` and no null id. ``counts`` says of the array ``run``
    whether it counts at all. Occurrences are ordered by ``doc_id``, ``_row`` and position.

    """
    runs = parts.where(F.size("parts") >= size).select(
        "doc_id",
        "_row",
        F.posexplode(
            F.expr(f"transform(sequence(1, size(parts) - {size - 1}), i -> slice(parts, i, {size}))")
        ).alias("at", "run"),
    )
    if counts is not None:
        runs = runs.where(counts)
    hashed = runs.select(
        "doc_id", "_row", "at", F.xxhash64("run").alias("k1"), F.xxhash64(F.lit(1), "run").alias("k2")
    )
    return later_keys(hashed)


def later_keys(hashed: DataFrame) -> DataFrame:
    """``doc_id, _row, at, first``: the rows of ``doc_id, _row, at, k1, k2`` whose keys occur earlier.

    One narrow shuffle of 64-bit hashes finds the few that repeat, a second one keeps their
    rows; what remains is compared by 128 bits. Groupings have partial counts and minima and
    the joins are plain, so a run that a third of all documents share is split.
    """
    repeated = hashed.groupBy("k1").agg(F.count("*").alias("n")).where("n > 1").select("k1")
    again = stored(hashed.join(repeated, "k1", "left_semi"))
    place = F.struct("doc_id", "_row", "at")
    first = again.groupBy("k1", "k2").agg(F.min(place).alias("first"))
    return again.join(first, ["k1", "k2"]).where(place != F.col("first")).select("doc_id", "_row", "at", "first")


def unpacked(rows: DataFrame, documents: DataFrame, **added: Column) -> DataFrame:
    """The columns of ``documents`` with the text of ``rows``, and ``added`` in place of equal names."""
    kept = [c for c in documents.columns if c not in added]
    columns = [F.col("text") if c == "text" else F.col("_all")[c].alias(c) for c in kept]
    return rows.select(*columns, *(value.alias(name) for name, value in added.items()))


def without_runs(documents: DataFrame, runs: DataFrame, size: int, parts: Column, joined: str) -> DataFrame:
    """``documents`` (with ``_row``) without the parts that ``runs`` cover.

    Adds ``_parts`` and ``_kept``, the numbers of parts before and after, and ``_first``, the ids
    of the documents that have the first occurrences. The runs of a document are at most as
    many as its parts; between two of them what is left is a slice of the array of parts.
    """
    found = runs.groupBy("doc_id", "_row").agg(
        F.sort_array(F.collect_list("at")).alias("_at"), F.sort_array(F.collect_set("first.doc_id")).alias("_first")
    )
    named = documents.where("doc_id is not null")
    both = named.join(found, ["doc_id", "_row"], "left").unionByName(
        documents.where("doc_id is null"), allowMissingColumns=True
    )
    slices = F.expr(
        f"""transform(sequence(0, size(_at)), j -> slice(
                _split,
                if(j = 0, 0, _at[j - 1] + {size}) + 1,
                greatest(0, if(j = size(_at), size(_split), _at[j]) - if(j = 0, 0, _at[j - 1] + {size}))))"""
    )
    left = F.flatten(slices)
    split = both.withColumn("_split", parts)
    return split.withColumns(
        {
            "_left": F.when(F.col("_at").isNull(), F.col("_split")).otherwise(left),
            "_first": F.coalesce("_first", F.array().cast("array<long>")),
        }
    ).withColumns(
        {
            "_parts": F.size("_split").cast("long"),
            "_kept": F.size("_left").cast("long"),
            "text": F.when(F.col("_at").isNull(), F.col("text")).otherwise(F.array_join("_left", joined)),
        }
    ).drop("_split", "_left", "_at")

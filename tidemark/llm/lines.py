"""Line dedup: windows of three consecutive lines that occur again are removed."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.runs import later_runs, unpacked, with_row, without_runs

LINES = 3


def repeated_lines_removed(documents: DataFrame, lines: int = LINES) -> DataFrame:
    """``documents`` with ``n_lines`` and ``n_removed``, and ``text`` without repeated lines.

    Lines are what ``\\n`` separates. Every window of ``lines`` consecutive lines that is not
    blank throughout is looked up over all documents; of equal windows the one with the
    smallest ``doc_id`` and position stays, and the lines that all later ones cover, overlapping
    or not, are removed. A text of fewer lines is never changed. The lines of a text that is
    covered from end to end leave an empty text; the document itself stays.

    A null text stays null, with no lines; an empty one has one line. Rows without id are not
    looked at. Rows that repeat both id and text count as one document and change alike.
    No documents give no rows; further columns are passed on, but for any of the names of the two
    counts. SQL functions only.
    """
    split = F.split("text", "\n", -1)
    rows = with_row(documents)
    parts = rows.where("doc_id is not null and text is not null").select(
        "doc_id", "_row", split.alias("parts")
    )
    runs = later_runs(parts, lines, F.trim(F.array_join("run", "")) != "")
    left = without_runs(rows, runs, lines, split, "\n")
    return unpacked(
        left,
        documents,
        n_lines=F.greatest("_parts", F.lit(0)).cast("long"),
        n_removed=F.greatest(F.col("_parts") - F.col("_kept"), F.lit(0)).cast("long"),
    )


def without_repeated_lines(documents: DataFrame, lines: int = LINES) -> DataFrame:
    """:func:`repeated_lines_removed` with the columns of ``documents``; ``n_chars`` follows the text."""
    packed = documents.select("doc_id", "text", F.struct(*documents.columns).alias("all"))
    out = repeated_lines_removed(packed, lines)
    changed = F.col("n_removed") > 0
    fields = {c: F.col("all")[c] for c in documents.columns} | {"text": F.col("text")}
    if "n_chars" in fields:
        length = F.when(changed, F.length("text")).otherwise(fields["n_chars"])
        fields["n_chars"] = length.cast(documents.schema["n_chars"].dataType)
    return out.select(*(value.alias(name) for name, value in fields.items()))


def oracle_sql() -> str:
    """The same rows as DuckDB SQL: ``doc_id, n_lines, n_removed, text``."""
    return f"""
        with l as (select doc_id, text, string_split(text, chr(10)) as parts from documents),
        w as (
            select doc_id, parts[i:i + {LINES - 1}] as run, i
            from (select doc_id, parts, unnest(generate_series(1, len(parts) - {LINES - 1})) as i
                  from l where doc_id is not null)
        ),
        later as (
            select doc_id, i, row_number() over (partition by run order by doc_id, i) as k
            from w where trim(array_to_string(run, ''), ' ') <> ''
        ),
        gone as (select distinct doc_id, unnest(generate_series(i, i + {LINES - 1})) as i from later where k > 1),
        each_line as (
            select doc_id, parts[i] as line, i
            from (select doc_id, parts, unnest(generate_series(1, len(parts))) as i from l)
        ),
        kept as (
            select e.doc_id, string_agg(e.line, chr(10) order by e.i) as text, count(*) as n
            from each_line e left join gone g on e.doc_id = g.doc_id and e.i = g.i
            where g.i is null group by e.doc_id
        )
        select l.doc_id, cast(coalesce(len(l.parts), 0) as bigint) as n_lines,
               cast(coalesce(len(l.parts), 0) - coalesce(k.n, 0) as bigint) as n_removed,
               case when l.text is null then null else coalesce(k.text, '') end as text
        from l left join kept k using (doc_id)"""

"""Exact dedup by distributed most-significant-digit radix partitioning."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import rows_of, store, with_row_keys

#: Bytes of the first digit, and how many times wider each later one is.
FIRST_DIGIT, WIDER = 64, 8


def _split(rows: DataFrame, body: Column, width: int, carried: list[str]) -> DataFrame:
    """Rows with the group that shares their next ``width`` bytes (null: alone), whether the text ended, and the bytes behind."""
    on = ["gid", "digit", "ended"]
    parts = rows.withColumns({"digit": F.substring(body, 1, width), "ended": F.octet_length(body) <= width})
    groups = parts.groupBy(on).agg(F.count("*").alias("n"), F.min("rid").alias("new")).filter("n > 1").drop("n")
    # read from a table and merged, so that run-time skew splitting can cut the rows of a hot group; never broadcast, as it grows
    groups = store(groups, "groups")
    rest = F.when(F.col("new").isNotNull() & ~F.col("ended"), F.substring(body, width + 1, 2**31 - 1))
    return parts.join(groups.hint("merge"), on, "left").select(*carried, F.col("new").alias("gid"), "ended", rest.alias("rest"))


def mark_copies(docs: DataFrame, first_digit: int = FIRST_DIGIT, wider: int = WIDER, rid: str | None = None) -> DataFrame:
    """doc_id, keep_id, group_size, kept and text_sha256 of each row of ``docs`` (doc_id, text; ``rid`` names a text column that tells its rows, to be carried).

    Texts are equal when their bytes are.  Round by round the documents of a group are split by their next bytes (a digit of 64
    bytes, then 512, 4096 and so on, so the rounds grow with the logarithm of the longest text) until a group is a single row or
    its texts end; the digits themselves are compared, never a digest.  Each round counts (group, digit) with a map-side
    combine and joins the count back, so a group that holds a third of all rows stays split over tasks.  After the first round
    only documents that share their first bytes with another one go on; they are written to the shared folder with the rest of
    their text.

    A null text counts as empty.  Of equal texts the row with the largest doc_id stays (null is smaller than any number); of rows
    that repeat both text and doc_id exactly one stays.  An empty table gives an empty result; other columns are not read.
    """
    if rid is None:  # told apart whenever the plan runs: a group is named by one of its rows, and both are read twice
        docs, rid = with_row_keys(docs).select("row.doc_id", "row.text", "rid"), "rid"
        return mark_copies(docs, first_digit, wider, rid).drop(rid)
    rows = docs.select(F.col("doc_id").cast("bigint").alias("id"), "text", F.col(rid).alias("rid"))
    body = F.coalesce("text", F.lit("")).cast("binary")
    rows = rows.withColumns({"sha": F.sha2(body, 256), "gid": F.lit("")})
    carried = ["id", "rid", "sha"]

    done, width = [], first_digit
    while True:
        table = store(_split(rows, body, width, carried), "digits")
        done.append(table.filter("gid is null or ended").select(*carried, F.coalesce("gid", "rid").alias("gid")))
        rows, body = table.filter("gid is not null and not ended").select(*carried, "gid", "rest"), F.col("rest")
        if rows.select("rid").isEmpty():
            break
        width *= wider
    every = done[0]
    for part in done[1:]:
        every = every.unionByName(part)
    last = F.max(F.struct("id", "rid")).alias("last")
    groups = every.groupBy("gid").agg(F.count("*").alias("size"), last).filter("size > 1")
    groups = store(groups, "groups")
    return every.join(groups.hint("merge"), "gid", "left").select(
        F.col("id").alias("doc_id"),
        F.when(F.col("last").isNull(), F.col("id")).otherwise(F.col("last.id")).alias("keep_id"),
        F.coalesce("size", F.lit(1)).cast("bigint").alias("group_size"),
        (F.col("last").isNull() | (F.col("rid") == F.col("last.rid"))).alias("kept"),
        F.col("sha").alias("text_sha256"),
        *([F.col("rid").alias(rid)] if rid else []),
    )


def exact_dedup(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns, whatever their names; cases as in ``mark_copies``."""
    keyed = with_row_keys(docs)
    marks = mark_copies(keyed.select("row.doc_id", "row.text", "rid"), rid="rid")
    return rows_of(keyed, marks.filter("kept")).select("row.*")

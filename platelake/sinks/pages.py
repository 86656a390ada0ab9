"""Ordered rows as pages with an index, and images stored once by their content.

A reader that wants one cell line asks the index for the pages that may hold it and reads those from the paged table, whose files
are sorted by page, so that all others are passed over by their statistics.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from platelake.operators.ranking import global_rank

PAGE_ROWS = 1000


def paged(rows: DataFrame, *order: Column, page_rows: int = PAGE_ROWS) -> DataFrame:
    """``rows`` with ``row_no`` (from 1, in ``order``) and ``page_no``, sorted by them."""
    numbered = global_rank(rows, *order, name="row_no")
    return numbered.withColumn("page_no", F.floor((F.col("row_no") - 1) / page_rows) + 1)


def page_index(pages: DataFrame, keys: Sequence[str], text: str = "line") -> DataFrame:
    """``page_no, first_row, n_rows, n_bytes`` (of the text, with line ends) and the first and last row's ``keys`` of each page."""
    ends = [F.struct(*keys).alias("k"), "row_no", "page_no", (F.octet_length(text) + 1).alias("size")]
    found = pages.select(*ends).groupBy("page_no").agg(
        F.min("row_no").alias("first_row"),
        F.count("*").alias("n_rows"),
        F.sum("size").alias("n_bytes"),
        F.min_by("k", "row_no").alias("first"),
        F.max_by("k", "row_no").alias("last"),
    )
    named = [F.col(f"{end}.{k}").alias(f"{end}_{k}") for end in ("first", "last") for k in keys]
    return found.select("page_no", "first_row", "n_rows", "n_bytes", *named)


def page(pages: DataFrame, page_no: int, text: str = "line") -> DataFrame:
    """The text of one page in its order."""
    return pages.filter(F.col("page_no") == page_no).orderBy("row_no").select(text)


def stored_once(images: DataFrame, content: str = "content") -> tuple[DataFrame, DataFrame]:
    """``images`` with a ``digest`` in place of the bytes, and ``digest, content, n_uses``: equal bytes are one row.

    Digests are counted first, so a picture that most rows share is sent once by each task.
    """
    named = images.withColumn("digest", F.sha2(content, 256))
    uses = named.groupBy("digest").agg(F.count("*").alias("n_uses"))
    bytes_of = named.filter(F.col("digest").isNotNull()).select("digest", content).dropDuplicates(["digest"])
    return named.drop(content), bytes_of.join(uses, "digest")

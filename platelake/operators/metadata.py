"""Cell-line metadata, gene markers and the consolidated table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from platelake.functions.numbers import round2
from platelake.operators.ranking import spread_sort

# Metadata columns and the gene markers that may be asked for.
INFO_COLUMNS = (
    "ModelID", "CellLine", "OncotreeLineage", "OncotreePrimaryDisease", "OncotreeSubtype", "OncotreeCode",
    "in_BioMetas",
)
GENE_MARKERS = (
    "TACSTD2", "CEACAM5", "ERBB2", "ERBB3", "MET", "EGFR", "CD276", "F3", "MUC1", "PTK7", "ITGB6", "FOLR1", "DLL3",
    "ADAM9", "LRRC15", "FAP", "ITGAV", "AXL", "CDCP1", "TPBG", "CEACAM6", "CLDN18", "MSLN", "MUC16", "CDH17",
    "SLFN11", "TOP1", "ABCB1", "ABCC3", "ABCG2", "PAF1",
)
DEFAULT_MARKERS = ("TACSTD2", "CEACAM5")


def known_markers(
    requested: Sequence[str], allowed: Sequence[str] = GENE_MARKERS, present: Sequence[str] | None = None
) -> tuple[list[str], list[str]]:
    """Requested markers that may be used, and those to warn about, such as those the metadata lacks (``present``)."""
    allowed_set = set(allowed) if present is None else set(allowed) & set(present)
    return [m for m in requested if m in allowed_set], [m for m in requested if m not in allowed_set]


def marker_panel(metadata: DataFrame, info: Sequence[str], markers: Sequence[str]) -> DataFrame:
    return metadata.select(*info, *[round2(F.col(m)).alias(m) for m in markers])


def _quoted(name: str) -> Column:
    return F.col("`" + name.replace("`", "``") + "`")


def join_metadata(
    wide: DataFrame,
    panel: DataFrame,
    key: str = "cell_line",
    batch: str = "batch",
    info: Sequence[str] = INFO_COLUMNS,
) -> DataFrame:
    """Every assay row with its metadata; names match without regard to case.

    ``key`` comes from the metadata, so it is NULL on rows without a match; ``assay_cell_line`` keeps the assay's name.
    Metadata listed twice yields two rows. No join hint: Spark broadcasts the panel when its size is below
    the threshold and otherwise shuffles, splitting hot names at run time.
    """
    info_rest = [c for c in info if c != key]
    markers = [c for c in panel.columns if c not in set(info)]
    values = [c for c in wide.columns if c not in ("cell_line", "batch")]
    left = wide.withColumnsRenamed({"cell_line": "assay_cell_line", "batch": "_batch"}).withColumn(
        "_match", F.upper("assay_cell_line")
    )
    right = panel.withColumn("_match", F.upper(key))
    return left.join(right, "_match", "left").select(
        key,
        F.col("_batch").alias(batch),
        *info_rest,
        *markers,
        *map(_quoted, values),
        "assay_cell_line",
    )


def in_report_order(consolidated: DataFrame, key: str = "cell_line", batch: str = "batch") -> DataFrame:
    return spread_sort(
        consolidated, F.asc_nulls_last(batch), F.asc_nulls_last(key), F.asc_nulls_last("assay_cell_line")
    )


def cells_per_batch(consolidated: DataFrame, key: str = "cell_line", batch: str = "batch") -> DataFrame:
    """Rows with a metadata name per batch; rows without a match are not counted."""
    return consolidated.groupBy(batch).agg(F.count(key).alias("n_cell_lines"))

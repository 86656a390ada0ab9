"""Identifiers held in file names, compound ids and sheet cells."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values.
WORKBOOK_SUFFIX = "_paste.xlsx"
SUMMARY_WORD = "Summary"
CONTROL_WORD = "stauro"
MARKER_WORDS = ("XLFit", "Chart")

# What Python's str.strip() removes from ASCII text.
BLANKS = " \t\n\r\f\v\x1c\x1d\x1e\x1f"


def strip(text: Column) -> Column:
    return F.btrim(text, F.lit(BLANKS))


def folder_of(path: Column) -> Column:
    """Name of the folder that directly holds ``path``."""
    return F.try_element_at(F.split(path, "/"), F.lit(-2))


def file_name_of(path: Column) -> Column:
    return F.substring_index(path, "/", -1)


def cell_line_of(file_name: Column, fallback: bool = False) -> Column:
    """Second ``_`` part of a workbook name; with ``fallback`` the bare name if there is none."""
    second = F.substring_index(F.substring_index(file_name, "_", 2), "_", -1)
    bare = F.replace(file_name, F.lit(".xlsx"), F.lit("")) if fallback else F.lit(None)
    return F.when(F.instr(file_name, "_") > 0, second).otherwise(bare)


def is_batch_folder(name: Column) -> Column:
    return name.endswith("cells")


def is_workbook_name(name: Column) -> Column:
    return name.endswith(WORKBOOK_SUFFIX) & ~name.startswith("~") & ~name.contains(SUMMARY_WORD)


def id_tail(value: Column) -> Column:
    """Text after the first ``_``; empty when there is none, also for a missing id."""
    at = F.instr(value, "_")
    return F.when(at > 0, value.substr(at + 1, F.length(value))).otherwise(F.lit(""))


def id_last(value: Column) -> Column:
    """Stripped text after the last ``_``; the whole text when there is none."""
    return F.substring_index(strip(value), "_", -1)


def is_control(compound: Column) -> Column:
    return F.coalesce(F.lower(compound).contains(CONTROL_WORD), F.lit(False))


def is_section_marker(text: Column) -> Column:
    first, second = MARKER_WORDS
    return F.coalesce(text.contains(first) & text.contains(second), F.lit(False))


def image_number(member: Column, extension: str = "emf") -> Column:
    """Number in ``imageN.<extension>``; 0 when the name has another form."""
    digits = F.regexp_extract(member, rf"image(\d+)\.{extension}", 1)
    return F.coalesce(digits.try_cast("long"), F.lit(0).cast("long"))


def picture_name(member: Column) -> Column:
    return F.replace(member, F.lit(".emf"), F.lit(".png"))

"""Text of the report table."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

IMAGE_WIDTH = 240
STYLE = (
    "body{font-family:sans-serif;margin:2em}table{border-collapse:collapse}"
    "th,td{border:1px solid #bbb;padding:4px;text-align:center;vertical-align:top}"
    f"img{{width:{IMAGE_WIDTH}px;height:auto}}small{{display:block;font-weight:normal}}"
)
PAGE_START = (
    f'<!DOCTYPE html><html lang="en"><head><meta charset="utf-8"><title>Dose-response plots</title><style>{STYLE}</style></head>'
    "<body><h1>Dose-response plots</h1><h2>Inhibition by cell line and compound</h2>"
)
TABLE_START = '<table><thead><tr><th scope="col">Cell line</th>'
HEAD_END = "</tr></thead><tbody>"
TABLE_END = "</tbody></table>"
PAGE_END = "</body></html>"
EMPTY_CELL = "<td></td>"
DEFAULT_COLOR = "#FFFFFF"  # fixed value

# How the text of an image's first bytes begins, and its media type.
MEDIA_TYPES = (
    ("iVBORw0KGgo", "image/png"),
    ("/9j/", "image/jpeg"),
    ("R0lGOD", "image/gif"),
    ("PHN2Zy", "image/svg+xml"),
    ("AQAAA", "image/emf"),
)


def escape(text: Column) -> Column:
    for raw, entity in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;")):
        text = F.replace(text, F.lit(raw), F.lit(entity))
    return text


def payload_text(content: Column) -> Column:
    """Base64 on one line, whatever ``spark.sql.chunkBase64String.enabled`` says."""
    return F.replace(F.base64(content), F.lit("\r\n"), F.lit(""))


def media_type(payload: Column) -> Column:
    """The media type that the first bytes of a payload text show."""
    found = F.lit("application/octet-stream")
    for beginning, kind in reversed(MEDIA_TYPES):
        found = F.when(payload.startswith(beginning), F.lit(kind)).otherwise(found)
    return found


def header_cell(compound: Column, display_name: Column) -> Column:
    named = F.coalesce(display_name, F.lit("")) != ""
    name = F.when(named, F.concat(F.lit("<small>"), escape(display_name), F.lit("</small>"))).otherwise(F.lit(""))
    return F.concat(F.lit('<th scope="col">'), escape(compound), name, F.lit("</th>"))


def image_cell(payload: Column, compound: Column, cell_line: Column) -> Column:
    picture = F.concat(
        F.lit('<td><img src="data:'), media_type(payload), F.lit(";base64,"), payload,
        F.lit('" alt="Plot of '), escape(compound), F.lit(" in "), escape(cell_line), F.lit('"></td>'),
    )
    return F.coalesce(picture, F.lit(EMPTY_CELL))


def line_header(cell_line: Column, color: Column) -> Column:
    return F.concat(F.lit('<th scope="row" style="background:'), escape(color), F.lit('">'), escape(cell_line), F.lit("</th>"))


def caption(n_compounds: Column, n_cell_lines: Column) -> Column:
    return F.concat(
        F.lit("<p>Compounds: "), n_compounds.cast("string"), F.lit("; cell lines: "), n_cell_lines.cast("string"),
        F.lit(". Plots show percent inhibition.</p>"),
    )

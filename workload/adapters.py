"""Assay-shaped views over the given tables.

The SQL is valid in Spark and in DuckDB: the queries run it in Spark over the given files, the SQL counterparts use it
as common table expressions over the registered views.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

ASSAY_RAW = """
select concat(l_returnflag, l_linestatus, ' cells') as batch,
       concat('20260122_S', cast(l_suppkey as string), '_7TA_144H_paste.xlsx') as file_name,
       concat('s', cast(l_suppkey as string), '_', p_brand) as compound_raw,
       case when l_linenumber = 7 or p_brand = 'Brand#9' then null
            when l_extendedprice > 80000 then '> 80000'
            when l_linenumber = 6 and l_discount = 0.0 then 'n.d.'
            else concat(cast(cast(l_extendedprice as decimal(12,2)) as string), '5') end as ic50_raw,
       case when l_quantity < 3 then null
            else concat(cast(cast(l_quantity + l_tax as decimal(12,2)) as string), '5') end as max_inhib_raw,
       l_orderkey, l_linenumber, l_partkey, l_suppkey
from {lineitem} join {part} on l_partkey = p_partkey
"""

COMPOUND_MAP = """
select case when cast(substr(p_brand, 7) as int) <= 12 then p_brand else concat('other ', p_brand) end as ta_id,
       concat('CMP-', substr(p_brand, 7)) as compound_name, cast(substr(p_brand, 7) as int) as row_no
from {part} group by p_brand
union all select 'Brand#1', 'CMP-1-new', 100
union all select 'Brand#2', null, 101
"""

CELL_META = """
select concat('ACH-', lpad(cast(s_suppkey as string), 6, '0')) as model_id,
       concat(case when s_suppkey % 10 = 3 then 'x' else 's' end, cast(s_suppkey as string)) as cell_line, r_name as lineage, n_name as disease,
       s_acctbal / 7 as gene_a, case when s_nationkey = 0 then null else s_acctbal / 3 end as gene_b
from {supplier} join {nation} on s_nationkey = n_nationkey join {region} on n_regionkey = r_regionkey
union all
select concat('DUP-', cast(s_suppkey as string)), concat('S', cast(s_suppkey as string)), 'dup', 'dup', 0.125, 2.675
from {supplier} where s_suppkey % 25 = 0
"""

# A hundred events make a sheet, so a row's number needs no window. Clicks are cells of all kinds.
GRID = """
select cast(floor(event_id / 100) as bigint) as workbook,
       case cast(floor(event_id / 100) as bigint) % 3 when 0 then 'Analyzed Data' when 1 then 'Data analysis for IC50' else 'Other' end as sheet,
       event_id % 100 + 1 as row_no,
       case event_type when 'signup' then case when user_id % 3 = 0 then 'XLFit Chart' else concat('U', cast(user_id as string), '_new') end
                       when 'purchase' then concat('U', cast(user_id as string), '_Staurosporine')
                       when 'error' then case when user_id % 4 = 0 then null else concat('U', cast(user_id as string), '_err') end
                       when 'click' then case user_id % 8 when 0 then '7' when 1 then '0.0' when 2 then 'True' when 3 then 'False'
                                                          when 4 then '#N/A' when 5 then '' when 6 then ' ' else 'plain' end
                       else concat('U', cast(user_id as string), '_', event_type) end as col_b,
       case when event_type = 'click' then case user_id % 8 when 0 then 'n' when 1 then 'n' when 2 then 'b' when 3 then 'b'
                                                            when 4 then 'e' else 's' end
            when event_type = 'error' and user_id % 4 = 0 then null else 's' end as value_type
from {events}
"""

# Folders and files of several kinds each.
BATCH_PATHS = """
select concat('file:/in [1]/', case event_id % 4 when 0 then '1st cells' when 1 then 'b% cells' when 2 then 'notes' else 'cells 2' end,
              case when event_type = 'error' then '/deep/' else '/' end, case when event_type = 'view' then '~' else '' end,
              '20260122_U', cast(user_id as string), '_', cast(event_id as string), case when event_type = 'click' then '.csv' else '.xlsx' end) as path
from {events}
"""
BOOK_BASE = "file:/in/__plots"
BOOK_PATHS = """
select concat(case when event_type = 'error' then 'file:/in/' else 'file:/in/__plots/' end,
              case event_id % 6 when 0 then '' when 1 then 'sub [1]/' when 2 then '__MACOSX/' when 3 then '.hidden/' when 4 then 'a/b/' else '_ok/' end,
              case event_type when 'view' then '~' else '' end, case when user_id % 5 = 0 then 'bare' else concat('20260122_U', cast(user_id as string)) end,
              case user_id % 7 when 0 then '_Summary' else '' end, case event_type when 'click' then '.xlsx' else '_paste.xlsx' end) as path, event_id
from {events}
"""

# Files to be written: in batch folders, other folders, hidden ones and deeper ones, with names of several kinds.
FOLDER_FILES = """
select concat(case s_nationkey % 7 when 0 then '1st cells/' when 1 then '_b [2] cells/' when 2 then 'notes 50%/' when 3 then ''
                                   when 4 then '.hidden cells/' when 5 then 'a/deep cells/' else '__x cells/' end,
              case s_suppkey % 4 when 0 then '_' when 1 then '.' when 2 then '~' else '' end, '20260122_S', cast(s_suppkey as string),
              case s_suppkey % 3 when 0 then '.xlsx' when 1 then '_paste.xlsx' else '_paste.csv' end) as path, s_name as body
from {supplier}
"""

# Every supplier has a file in two batches; some files have no row.
FILE_LIST = """
select 'A cells' as batch, concat('20260122_S', cast(s_suppkey as string), '_7TA_144H_paste.xlsx') as file_name from {supplier}
union all
select 'N cells' as batch, concat('20260122_S', cast(s_suppkey as string), '_7TA_144H_paste.xlsx') as file_name from {supplier}
"""
FILE_ROWS = """
select concat(l_returnflag, ' cells') as batch, concat('20260122_S', cast(l_suppkey as string), '_7TA_144H_paste.xlsx') as file_name
from {lineitem} where l_returnflag <> 'R' and l_suppkey % 5 <> 2
"""

# Options with a key listed twice in one object.
OPTION_TEXT = """
select concat('{{"', event_type, '": "', cast(event_id as string), '", "all": "', event_type, '", "', event_type, '": "',
              cast(event_id + 1 as string), '"}}') as options, event_id
from {events}
"""

# Metadata and bar values as texts, with the texts that stand for no value.
META_TEXT = """
select cast(s_suppkey as string) as ModelID, s_name as CellLine,
       case s_nationkey % 5 when 0 then 'NA' when 1 then 'n/a' else n_name end as OncotreeLineage,
       case when s_nationkey = 3 then 'NaN' when s_nationkey = 4 then 'x' else cast(s_acctbal as string) end as TACSTD2, s_acctbal as MET
from {supplier} join {nation} on s_nationkey = n_nationkey
"""
BAR_TEXT = """
select s_name as gene, case s_nationkey when 1 then 'nan' when 2 then '' when 3 then '1.0d' when 4 then concat('>', cast(s_acctbal as string))
                                        else cast(s_acctbal as string) end as value
from {supplier}
"""
BATCH_FILES = """
select concat(l_returnflag, l_linestatus, case when l_returnflag = 'N' and l_linestatus = 'F' then ' notes' else ' cells' end) as batch,
       concat('20260122_S', cast(l_suppkey as string), '_7TA_144H_paste.xlsx') as file_name
from {lineitem}
"""

SHEETS = """
select user_id as workbook,
       case (user_id + event_id) % 5 when 0 then 'Analyzed Data' when 1 then 'Data analysis for IC50'
            else concat('Sheet', cast((user_id + event_id) % 5 as string)) end as sheet
from {events}
"""

ASSETS = """
select regexp_extract(url, '://([^/?#]+)', 1) as workbook, page_id as image_no, html from {pages}
"""

BARS = "select s_name as gene, s_acctbal as value from {supplier}"

# A palette for each region, with a stop for each of its nations.
PALETTE_STOPS = """
select n_regionkey as palette, cast(n_nationkey as double) / 24 as t, cast(n_nationkey * 10 as double) as r, cast(255 - n_nationkey * 7 as double) as g,
       cast((n_nationkey * 53) % 256 as double) as b
from {nation}
"""
PALETTE_VALUES = """
select s_name as gene, n_regionkey as palette, s_acctbal as value from {supplier} join {nation} on s_nationkey = n_nationkey
"""

INFO = ("model_id", "lineage", "disease")
REQUESTED_MARKERS = ("gene_a", "gene_x", "gene_y", "gene_b")
AVAILABLE_MARKERS = ("gene_a", "gene_b", "gene_c")

ORDER = ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
# Bits of a line's number and of a part's key in the reading order; the order's key has the 33 above them. A supplier is a file.
LINE_BITS, PART_BITS = 3, 27


# The columns used, declared so that opening a table needs no job to read a footer.
SCHEMAS = {
    "lineitem": "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, "
    "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string",
    "part": "p_partkey long, p_brand string",
    "supplier": "s_suppkey long, s_name string, s_nationkey int, s_acctbal double",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "region": "r_regionkey int, r_name string",
    "events": "event_id long, user_id long, event_type string, props string",
    "pages": "page_id long, url string, html string",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet")


def view(spark: SparkSession, sf_dir: str, text: str) -> DataFrame:
    names = set(re.findall(r"\{(\w+)\}", text))
    found = {n: table(spark, sf_dir, n) for n in names}
    return spark.sql(text, **found)


def plain(text: str) -> str:
    """The view's SQL over tables registered by name."""
    named = re.sub(r"\{(\w+)\}", r"\1", text).strip()
    return named.replace("{{", "{").replace("}}", "}")


def assay_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw readings with ``ord``, the reading order within a file (a supplier): order, line and part in one long."""
    fits = (F.col("l_linenumber") < 1 << LINE_BITS) & (F.col("l_partkey") < 1 << PART_BITS)
    line = F.shiftleft("l_orderkey", LINE_BITS).bitwiseOR(F.col("l_linenumber").cast("long"))
    packed = F.shiftleft(line, PART_BITS).bitwiseOR(F.col("l_partkey"))
    order = F.when(fits, packed).otherwise(F.raise_error(F.lit("key beyond the reading order")))
    return view(spark, sf_dir, ASSAY_RAW).withColumn("ord", order).drop(*ORDER)


def compound_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    return view(spark, sf_dir, COMPOUND_MAP)


def cell_meta(spark: SparkSession, sf_dir: str) -> DataFrame:
    return view(spark, sf_dir, CELL_META)


def section_grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The event grid as cells of column 2."""
    return view(spark, sf_dir, GRID).select(
        "workbook",
        "sheet",
        F.col("row_no").alias("row"),
        F.lit(2).alias("col"),
        F.col("col_b").alias("value"),
        "value_type",
    )


def assets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages as images: the host is the workbook, and hosts below one registered domain share a cell line."""
    return view(spark, sf_dir, ASSETS).select(
        F.col("workbook").alias("path"),
        F.substring_index("workbook", ".", 1).alias("cell_line"),
        "image_no",
        F.concat(F.lit("image"), F.col("image_no").cast("string"), F.lit(".emf")).alias("member"),
        F.octet_length("html").cast("long").alias("n_bytes"),
        F.encode("html", "UTF-8").alias("content"),
    )


def bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    return view(spark, sf_dir, BARS)

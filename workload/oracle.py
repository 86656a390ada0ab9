"""The same results in SQL over the registered tables, written on their own rather than from the Spark plans."""

from __future__ import annotations

from workload import adapters
from workload.adapters import plain

ORDER = "l_orderkey, l_linenumber, l_partkey, l_suppkey"
BRANDS = [f"Brand#{i}" for i in range(1, 26)]
# Names of the first twelve brands are mapped; number 1 is renamed, number 2 loses its name, number 9 has no IC50.
COMPOUNDS = sorted(
    {"CMP-1-new"} | {f"CMP-{i}" for i in range(3, 13) if i != 9} | {f"Brand#{i}" for i in range(13, 26)}
)


def with_(*parts: tuple[str, str], select: str) -> str:
    return "with " + ",\n".join(f"{name} as ({body})" for name, body in parts) + "\n" + select


def _number(raw: str) -> str:
    core = f"trim(replace({raw}, '>', ''))"
    form = "^[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)([eE][+-]?[0-9]+)?$"
    parsed = f"case when regexp_matches({core}, '{form}') then try_cast({core} as double) end"
    return _two_places(parsed)


def _two_places(value: str) -> str:
    return f"case when ({value}) is not null then cast(printf('%.2f', {value}) as double) + 0.0 end"


RAW = ("assay_raw", plain(adapters.ASSAY_RAW))
CLEAN = (
    "clean",
    f"""
    select batch, split_part(file_name, '_', 2) as cell_line,
           case when instr(compound_raw, '_') > 0 then substr(compound_raw, instr(compound_raw, '_') + 1) else '' end
             as compound,
           {_number('ic50_raw')} as ic50, {_number('max_inhib_raw')} as max_inhib, ic50_raw, max_inhib_raw,
           coalesce(contains(ic50_raw, '>'), false) as ic50_censored, {ORDER}
    from assay_raw""",
)
MAP_ROWS = ("compound_map", plain(adapters.COMPOUND_MAP))
NAMES = (
    "names",
    """
    select ta_id, compound_name
    from (select *, row_number() over (partition by ta_id order by row_no desc) as back from compound_map)
    where back = 1""",
)
MAPPED = (
    "mapped",
    f"""
    select batch, cell_line, case when ta_id is null then compound else compound_name end as compound,
           ic50, max_inhib, ic50_raw, max_inhib_raw, ic50_censored, {ORDER}
    from clean left join names on compound = ta_id""",
)


def _first(value: str, raw: str) -> str:
    return f"first({value} order by {ORDER}) filter (where {raw} is not null)"


FIRST = (
    "firsts",
    f"""
    select cell_line, batch, compound,
           {_first('ic50', 'ic50_raw')} as ic50, {_first('max_inhib', 'max_inhib_raw')} as max_inhib,
           {_first('ic50_raw', 'ic50_raw')} as ic50_first_raw,
           {_first('max_inhib_raw', 'max_inhib_raw')} as max_inhib_first_raw
    from mapped where compound is not null group by cell_line, batch, compound""",
)
TO_FIRST = (RAW, CLEAN, MAP_ROWS, NAMES, MAPPED, FIRST)

WIDE_COLUMNS = ", ".join(f"max(case when compound = '{c}' then ic50 end) as \"{c}_IC50\"" for c in COMPOUNDS) + ", " + (
    ", ".join(f"max(case when compound = '{c}' then max_inhib end) as \"{c}_INHIB\"" for c in COMPOUNDS)
)
WIDE = (
    "wide",
    f"""
    select cell_line, batch, {WIDE_COLUMNS}
    from firsts where ic50_first_raw is not null or max_inhib_first_raw is not null
    group by cell_line, batch""",
)
META = ("cell_meta", plain(adapters.CELL_META))
PANEL = (
    "panel",
    f"""
    select cell_line, model_id, lineage, disease, {_two_places('gene_a')} as gene_a, {_two_places('gene_b')} as gene_b
    from cell_meta""",
)
CONSOLIDATED = (
    "consolidated",
    """
    select p.cell_line, w.batch, p.model_id, p.lineage, p.disease, p.gene_a, p.gene_b,
           w.* exclude (cell_line, batch), w.cell_line as assay_cell_line
    from wide w left join panel p on upper(w.cell_line) = upper(p.cell_line)""",
)
TO_CONSOLIDATED = (*TO_FIRST, WIDE, META, PANEL, CONSOLIDATED)

GRID = ("grid", plain(adapters.GRID))
# Row by row as flags: seen a marker before, entries so far, stopped.
SECTIONS = (
    # Empty cells leave the grid; a row that is not there counts as empty.
    ("filled", """
    select workbook, sheet, row_no, col_b, value_type in ('s', 'e') as is_text from grid
    where col_b is not null and not (value_type = 's' and col_b = '') and not (value_type = 'b' and col_b = 'False')
      and not (value_type = 'n' and try_cast(col_b as double) = 0)"""),
    ("g0", """
    select workbook, row_no, col_b,
           case when is_text and col_b like '%XLFit%' and col_b like '%Chart%' then 1 else 0 end as is_marker,
           is_text, row_no - lag(row_no) over (partition by workbook order by row_no) > 1 as gap
    from filled where sheet in ('Analyzed Data', 'Data analysis for IC50')"""),
    ("g1", """
    select *, coalesce(max(is_marker) over (partition by workbook order by row_no
              rows between unbounded preceding and 1 preceding), 0) as in_section from g0"""),
    ("g2", """
    select *, case when in_section = 1 and is_marker = 0 and is_text and trim(col_b) <> ''
                    and lower(col_b) not like '%stauro%' then 1 else 0 end as kept from g1"""),
    ("g3", """
    select *, coalesce(sum(kept) over (partition by workbook order by row_no
              rows between unbounded preceding and 1 preceding), 0) as kept_before from g2"""),
    ("g4", """
    select *, max(case when in_section = 1 and gap and kept_before > 0 then 1 else 0 end)
              over (partition by workbook order by row_no
              rows between unbounded preceding and current row) as stopped from g3"""),
    ("entries", """
    select workbook, cast(row_number() over (partition by workbook order by row_no) as integer) as plot_no,
           cast(row_no as integer) as row, split_part(trim(col_b), '_', -1) as compound
    from g4 where kept = 1 and stopped = 0"""),
)

ASSETS = ("assets", plain(adapters.ASSETS))
BIG_ASSETS = (
    "big_assets",
    """
    select workbook as path, split_part(workbook, '.', 1) as cell_line, image_no, html,
           octet_length(encode(html)) as n_bytes,
           cast(row_number() over (partition by workbook order by image_no) as integer) as plot_no
    from assets where octet_length(encode(html)) > 3000""",
)
PLOT_ORDER = (
    ("first_book", """
    select min(workbook) as workbook from grid where sheet in ('Analyzed Data', 'Data analysis for IC50')"""),
    ("plot_order", "select plot_no, compound from entries where workbook = (select workbook from first_book)"),
)
PICTURES = (
    ("pictures", """
    select path, cell_line, plot_no, to_base64(encode(html)) as payload
    from big_assets where plot_no <= (select count(*) from plot_order)"""),
    ("last_books", "select cell_line, max(path) as path from pictures group by cell_line"),
    # A compound listed twice shows its last picture in both columns.
    ("shown", """
    select p.cell_line, p.path, o.compound, max_by(p.payload, p.plot_no) as payload
    from pictures p join last_books using (cell_line, path) join plot_order o using (plot_no)
    group by p.cell_line, p.path, o.compound"""),
    ("display_names", """
    select distinct event_type as compound, concat('A&', upper(event_type)) as display_name
    from events"""),
    ("dense", """
    select b.cell_line, o.plot_no, o.compound, coalesce(n.display_name, '') as display_name,
           case when b.cell_line like 't%' then '#90EE90' else '#ADD8E6' end as color, b.path, s.payload
    from last_books b cross join plot_order o
    left join shown s on s.cell_line = b.cell_line and s.compound = o.compound
    left join display_names n on n.compound = o.compound"""),
)
TO_DENSE = (GRID, *SECTIONS, *PLOT_ORDER, ASSETS, BIG_ASSETS, *PICTURES)

BARS = ("bars", plain(adapters.BARS))
PLACED = (
    "placed",
    """
    select gene, value, case when value is null then null when hi = lo then 0.0 else (value - lo) / (hi - lo) end as t
    from bars cross join (select min(value) as lo, max(value) as hi from bars)""",
)
AXIS = (
    "axis",
    """
    select *, case when value < 0 then 'below' when value <= 2000 then 'left' when value < 6000 then 'gap'
                   when value > 8000 then 'above' when value is not null then 'right' end as segment,
           case when value is not null then greatest(least(value, 2000.0::double), 0.0::double) end as left_len,
           case when value is not null then greatest(least(value, 8000.0::double), 6000.0::double) - 6000.0::double end
             as right_len
    from placed""",
)


def _stops(name: str, stops: tuple) -> tuple[str, str]:
    pairs = enumerate(zip(stops, stops[1:]))
    rows = ", ".join(
        "(" + ", ".join(f"{x!r}::double" for x in (*low, *high)) + f", {i})" for i, (low, high) in pairs
    )
    return name, f"select * from (values {rows}) v(t0, a0, b0, c0, t1, a1, b1, c1, n)"


def _line(at: str, k: str) -> str:
    return f"s.{k}0 + ({at} - s.t0) / (s.t1 - s.t0) * (s.{k}1 - s.{k}0)"


def _hex(channels: list[str]) -> str:
    digits = [
        f"lpad(upper(hex(cast(floor(least(greatest({c}, 0.0), 255.0) + 0.5) as bigint))), 2, '0')" for c in channels
    ]
    return "concat('#', " + ", ".join(f"right({d}, 2)" for d in digits) + ")"


# Written out, so that a wrong constant of the library shows: place and channels (0-255) of the gradient, its
# Lab values, the diverging map's channels at each thirty-second, and the D65 constants.
GRADIENT_STOPS = (
    (0.0, 59.0, 76.0, 192.0),
    (0.15254237288135594, 123.0, 159.0, 249.0),
    (0.3220338983050847, 201.0, 215.0, 240.0),
    (0.4915254237288136, 247.0, 212.0, 207.0),
    (0.6610169491525424, 240.0, 138.0, 108.0),
    (1.0, 180.0, 4.0, 38.0),
)
LAB_STOPS = (
    (0.0, 37.66798403654112, 32.096063873925885, -62.82964402765607),
    (0.15254237288135594, 66.40070946897752, 12.06432728391993, -48.73019591183041),
    (0.3220338983050847, 85.65949100458761, 0.31378781666335787, -13.826382357984235),
    (0.4915254237288136, 87.66358394436182, 11.409691219603669, 6.9914078124841295),
    (0.6610169491525424, 67.86532827038889, 35.94630369143509, 32.9025194624238),
    (1.0, 37.72253473464891, 61.90534819937191, 34.025139135241346),
)
DIVERGING_STOPS = (
    (0.0, 58.600453499999944, 76.17308133000003, 192.189204015),
    (0.03125, 67.8887706811657, 90.0389382902623, 204.37430580428145),
    (0.0625, 77.48491583292558, 103.66608172993632, 215.46498043231065),
    (0.09375, 87.41278110982852, 116.98264310446696, 225.3508114217244),
    (0.125, 97.66542613500658, 129.90119619999462, 233.93473244691583),
    (0.15625, 108.21075802926357, 142.32699879185066, 241.1339030117132),
    (0.1875, 118.99620274019048, 154.1625731545106, 246.88041780766923),
    (0.21875, 129.95277656984806, 165.31057346918416, 251.12183666328906),
    (0.25, 140.9986743543805, 175.67577718170728, 253.82152608256254),
    (0.28125, 152.04241297938748, 185.16659110414133, 254.958806958857),
    (0.3125, 162.98556114727407, 193.69626609884145, 254.52890624455608),
    (0.34375, 173.72509454617133, 201.18392049657322, 252.54271317135704),
    (0.375, 184.15542209924547, 207.55542497874492, 249.0263429954447),
    (0.40625, 194.17013021364352, 212.74417629489844, 244.02051306257056),
    (0.4375, 203.6634889944906, 216.6917728587674, 237.57973703930222),
    (0.46875, 212.5317592185919, 219.34859660398436, 229.7713430908508),
    (0.5, 220.67433305881252, 220.67429968114854, 220.6743200221168),
    (0.53125, 228.9277292339788, 216.4727019539855, 209.32045026435762),
    (0.5625, 235.63919192863003, 210.97620862084287, 197.4933612579165),
    (0.59375, 240.82188620562755, 204.22912609927326, 185.30956351910783),
    (0.625, 244.4866902466779, 196.28322519528515, 172.88239230628858),
    (0.65625, 246.64556154310543, 187.19638621454882, 160.32097349688922),
    (0.6875, 247.31383774994933, 177.030835890958, 147.72931491515467),
    (0.71875, 246.51184521127715, 165.85076313810245, 135.20553201282758),
    (0.75, 244.2660351950275, 153.71892695235925, 122.8412170641792),
    (0.78125, 240.6097815658734, 140.69151656066637, 110.72096263433815),
    (0.8125, 235.58392297470192, 126.80975274006, 98.92205373941465),
    (0.84375, 229.2371019574288, 112.08487732834041, 87.51434999039954),
    (0.875, 221.62593429231165, 96.46823080258366, 76.56039097445868),
    (0.90625, 212.81502997627427, 79.78251412094333, 66.11577825465896),
    (0.9375, 202.87687964639957, 61.52787981287465, 56.22992065195679),
    (0.96875, 191.8916157250455, 40.098868052989765, 46.94728352696733),
    (1.0, 179.94665529, 3.966820800000032, 38.309367060000014),
)
M = (
    (3.240454836021409, -1.5371388501025753, -0.498531546868481),
    (-0.9692663898756538, 1.8760109288424913, 0.041556082346673524),
    (0.05564341960421366, -0.20402585426769815, 1.0572251624579287),
)
WHITE = (0.95047, 1.0, 1.08883)


def _channel(row: list[float]) -> str:
    c = f"({row[0]!r} * x + {row[1]!r} * y + {row[2]!r} * z)"
    return f"255.0 * case when {c} <= 0.0031308 then 12.92 * {c} else 1.055 * pow({c}, 1 / 2.4) - 0.055 end"


def _cube(f: str, white: float) -> str:
    return f"{white!r} * case when {f} > 6.0 / 29 then {f} * {f} * {f} else 3 * pow(6.0 / 29, 2) * ({f} - 4.0 / 29) end"


COLORED = (
    _stops("diverging_stops", DIVERGING_STOPS),
    _stops("gradient_stops", GRADIENT_STOPS),
    _stops("lab_stops", LAB_STOPS),
    ("levels", "select *, least(floor(t * 256), 255) / 255 as place from placed"),
    ("diverging_fill", f"""
    select gene, {_hex([_line('place', k) for k in 'abc'])} as diverging
    from levels join diverging_stops s on (place > s.t0 or s.n = 0) and place <= s.t1"""),
    ("rgb_fill", f"""
    select gene, {_hex([_line('t', k) for k in 'abc'])} as gradient_rgb
    from levels join gradient_stops s on (t > s.t0 or s.n = 0) and t <= s.t1"""),
    ("lab_fill", f"""
    select gene, {_line('t', 'a')} as l, {_line('t', 'b')} as a, {_line('t', 'c')} as b
    from levels join lab_stops s on (t > s.t0 or s.n = 0) and t <= s.t1"""),
    ("f_fill", "select gene, (l + 16) / 116 as fy, (l + 16) / 116 + a / 500 as fx, (l + 16) / 116 - b / 200 as fz from lab_fill"),
    ("xyz_fill", f"""
    select gene, {_cube('fx', WHITE[0])} as x, {_cube('fy', WHITE[1])} as y,
           {_cube('fz', WHITE[2])} as z from f_fill"""),
    ("gradient_fill", f"select gene, {_hex([_channel(r) for r in M])} as gradient from xyz_fill"),
)
FILLS = "join diverging_fill using (gene) join gradient_fill using (gene) join rgb_fill using (gene)"

HEADS = """
select 1 as g, column_name, label, '' as band, n from (values ('cell_line', 'cell_line', 1), ('batch', 'batch', 2))
  v(column_name, label, n)
union all select 2, c, c, 'Metadata', n from (values ('model_id', 1), ('lineage', 2), ('disease', 3)) v(c, n)
union all select 3, c, c, 'Gene', n from (values ('gene_a', 1), ('gene_b', 2)) v(c, n)
union all select 4, concat(compound, '_IC50'), compound, 'IC50', row_number() over (order by compound) from measured
union all select 5, concat(compound, '_INHIB'), compound, 'Max%Inhib', row_number() over (order by compound)
  from measured
"""

TH = """concat('<th scope="col">', compound,
        case when display_name <> '' then concat('<small>', replace(display_name, '&', '&amp;'), '</small>') else '' end, '</th>')"""
TD = """case when payload is null then '<td></td>'
        else concat('<td><img src="data:application/octet-stream;base64,', payload, '" alt="Plot of ', compound, ' in ', cell_line,
                    '"></td>') end"""
PAGE = (
    '<!DOCTYPE html><html lang="en"><head><meta charset="utf-8"><title>Dose-response plots</title><style>'
    "body{font-family:sans-serif;margin:2em}table{border-collapse:collapse}"
    "th,td{border:1px solid #bbb;padding:4px;text-align:center;vertical-align:top}"
    "img{width:240px;height:auto}small{display:block;font-weight:normal}</style></head>"
    "<body><h1>Dose-response plots</h1><h2>Inhibition by cell line and compound</h2>"
    '<table><thead><tr><th scope="col">Cell line</th>'
)

_SHEET = ["cell_line", "batch", "model_id", "lineage", "disease", "gene_a", "gene_b"]
_SHEET += [f"{c}_IC50" for c in COMPOUNDS] + [f"{c}_INHIB" for c in COMPOUNDS]
SHEET_CELLS = ", ".join(f"coalesce(cast(\"{c}\" as varchar), '')" for c in _SHEET)
# The same columns, a text standing where a number is missing.
SHEET_WIDE = (
    "wide",
    "select cell_line, batch, "
    + ", ".join(
        f"max(case when compound = '{c}' then coalesce(cast({m} as varchar), {m}_first_raw) end) as \"{c}_{label}\""
        for m, label in (("ic50", "IC50"), ("max_inhib", "INHIB"))
        for c in COMPOUNDS
    )
    + " from firsts where ic50_first_raw is not null or max_inhib_first_raw is not null group by cell_line, batch",
)
LABEL_LINE = ",".join(_SHEET[:7] + COMPOUNDS + COMPOUNDS)
BAND_LINE = ",".join(
    ["", "", "Metadata", "", "", "Gene", ""] + ["IC50"] + [""] * (len(COMPOUNDS) - 1) + ["Max%Inhib"] + [""] * (len(COMPOUNDS) - 1)
)

CLEAN_COLUMNS = "batch, cell_line, compound, ic50, max_inhib, ic50_raw, max_inhib_raw, ic50_censored"

ORACLE_SQL: dict[str, str] = {
    "batch_catalog": """
        select concat(l_returnflag, l_linestatus, ' cells') as batch, count(distinct l_suppkey) as n_files, count(*) as n_rows
        from lineitem where not (l_returnflag = 'N' and l_linestatus = 'F') group by batch""",
    "batch_listing": """
        select path, kind as batch, name as file_name, split_part(name, '_', 2) as cell_line
        from (select concat('file:/in [1]/', case event_id % 4 when 0 then '1st cells' else 'b% cells' end, '/20260122_U', user_id, '_', event_id, '.xlsx') as path,
                     case event_id % 4 when 0 then '1st cells' else 'b% cells' end as kind,
                     concat('20260122_U', user_id, '_', event_id, '.xlsx') as name
              from events where event_id % 4 < 2 and event_type not in ('error', 'view', 'click'))""",
    "workbook_listing": """
        select concat('file:/in/__plots/', case event_id % 6 when 0 then '' when 1 then 'sub [1]/' else '_ok/' end, name) as path, event_id, name as file_name,
               split_part(name, '_', 2) as cell_line
        from (select *, concat(case when user_id % 5 = 0 then 'bare' else concat('20260122_U', user_id) end, '_paste.xlsx') as name from events)
        where event_id % 6 in (0, 1, 5) and event_type not in ('error', 'view', 'click') and user_id % 7 <> 0""",
    "file_counts": """
        with files as (
          select batch, concat('20260122_S', s_suppkey, '_7TA_144H_paste.xlsx') as file_name, s_suppkey
          from supplier, (values ('A cells'), ('N cells')) v(batch)
        )
        select batch, file_name, count(*) over (partition by batch) as n_files,
               (select count(*) from lineitem where l_suppkey = s_suppkey and concat(l_returnflag, ' cells') = batch and l_suppkey % 5 <> 2) as n_rows
        from files""",
    "clean_readings": with_(RAW, CLEAN, select=f"select {CLEAN_COLUMNS} from clean"),
    "rejected_values": with_(
        RAW,
        CLEAN,
        select="""
        select batch, cell_line, compound, 'ic50' as metric, ic50_raw as value from clean
        where ic50_raw is not null and ic50 is null
        union all
        select batch, cell_line, compound, 'max_inhib', max_inhib_raw from clean
        where max_inhib_raw is not null and max_inhib is null""",
    ),
    "compound_names": with_(MAP_ROWS, NAMES, select="select ta_id, compound_name from names"),
    "mapped_readings": with_(RAW, CLEAN, MAP_ROWS, NAMES, MAPPED, select=f"select {CLEAN_COLUMNS} from mapped"),
    "first_readings": with_(
        *TO_FIRST,
        select="""
        select cell_line, batch, compound, ic50, max_inhib,
               case when ic50 is null then ic50_first_raw end as ic50_text,
               case when max_inhib is null then max_inhib_first_raw end as max_inhib_text
        from firsts""",
    ),
    "wide_readings": with_(*TO_FIRST, WIDE, select="select * from wide"),
    "metadata_source": """
        select cast(s_suppkey as varchar) as ModelID, s_name as CellLine,
               case when s_nationkey % 5 > 1 then n_name end as OncotreeLineage,
               case when s_nationkey not in (3, 4) then s_acctbal end as TACSTD2, s_acctbal as MET
        from supplier join nation on s_nationkey = n_nationkey""",
    "marker_panel": with_(META, PANEL, select="select * from panel"),
    "consolidated": with_(*TO_CONSOLIDATED, select="select * from consolidated"),
    "cells_per_batch": with_(
        *TO_CONSOLIDATED, select="select batch, count(cell_line) as n_cell_lines from consolidated group by batch"
    ),
    "run_summary": with_(
        *TO_CONSOLIDATED,
        select=f"""
        select (select count(*) from mapped) as n_readings,
               (select count(*) from mapped where ic50_raw is not null and ic50 is null) as n_ic50_texts,
               (select count(*) from mapped where max_inhib_raw is not null and max_inhib is null) as n_max_inhib_texts,
               (select count(*) from mapped where ic50_censored) as n_censored,
               (select count(distinct batch) from mapped) as n_batches,
               (select count(distinct concat(batch, '/', cell_line)) from mapped) as n_cell_lines,
               (select count(distinct compound) from firsts where ic50_first_raw is not null) as n_compounds,
               (select count(*) from consolidated) as n_rows,
               (select count(cell_line) from consolidated) as n_matched_rows,
               cast({7 + 2 * len(COMPOUNDS)} as integer) as n_columns""",
    ),
    "header_bands": with_(
        *TO_FIRST,
        ("measured", "select distinct compound from firsts where ic50_first_raw is not null"),
        ("heads", HEADS),
        ("placed_heads", "select *, row_number() over (order by g, n) as ordinal from heads"),
        select="""
        select cast(ordinal as integer) as ordinal, column_name, label, band,
               cast(min(ordinal) over (partition by g) as integer) as start_col,
               cast(max(ordinal) over (partition by g) as integer) as end_col
        from placed_heads""",
    ),
    "section_entries": with_(GRID, *SECTIONS, select="select * from entries"),
    "sheet_choice": with_(
        ("sheets", plain(adapters.SHEETS)),
        select="""
        select workbook, case when bool_or(sheet = 'Analyzed Data') then 'Analyzed Data'
                              else 'Data analysis for IC50' end as sheet
        from sheets where sheet in ('Analyzed Data', 'Data analysis for IC50') group by workbook""",
    ),
    "first_workbook": with_(
        ASSETS,
        select="""
        select split_part(workbook, '.', 1) as cell_line, workbook as path
        from assets order by cell_line, path limit 1""",
    ),
    "plot_assets": with_(
        GRID,
        *SECTIONS,
        *PLOT_ORDER,
        ASSETS,
        BIG_ASSETS,
        select="""
        select path, cell_line, image_no, plot_no, n_bytes, concat('image', cast(image_no as varchar), '.png') as picture,
               to_base64(encode(html)) as payload
        from big_assets where plot_no <= (select count(*) from plot_order)""",
    ),
    "plot_grid": with_(*TO_DENSE, select="select * from dense"),
    "plot_report": with_(
        *TO_DENSE,
        select=f"""
        select cast(0 as integer) as section, cast(null as varchar) as cell_line,
               concat('{PAGE}', coalesce(string_agg({TH}, '' order by plot_no), ''), '</tr></thead><tbody>') as line
        from (select o.plot_no, o.compound, coalesce(n.display_name, '') as display_name
              from plot_order o left join display_names n using (compound))
        union all
        select 1, cell_line,
               concat('<tr><th scope="row" style="background:', any_value(color), '">', cell_line, '</th>',
                      string_agg({TD}, '' order by plot_no), '</tr>')
        from dense group by cell_line
        union all
        select 2, null, concat('</tbody></table><p>Compounds: ', (select count(*) from plot_order), '; cell lines: ',
               count(*), '. Plots show percent inhibition.</p></body></html>')
        from last_books""",
    ),
    "json_options": """
        select event_id, key, json_extract_string(props, concat('$."', key, '"')) as value
        from (select event_id, props, unnest(json_keys(props)) as key from events)""",
    "option_lookup": """
        select event_id, event_type as key, cast(event_id + 1 as varchar) as value from events
        union all select event_id, 'all', event_type from events""",
    "bar_values": """
        select s_name as gene, case when s_nationkey not in (1, 2, 3) then s_acctbal end as value from supplier""",
    "bar_axis": with_(BARS, PLACED, AXIS, select="select * from axis"),
    "bar_colors": with_(
        BARS, PLACED, *COLORED, select=f"select gene, value, t, diverging, gradient, gradient_rgb from placed {FILLS}"
    ),
    "bar_ranked": with_(
        BARS,
        PLACED,
        AXIS,
        *COLORED,
        select=f"""
        select row_number() over (order by value nulls last, gene) as rank, gene, value, t, segment, left_len, right_len,
               diverging, gradient, gradient_rgb
        from axis {FILLS}""",
    ),
    "workbook_ingest": """
        select l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice, l_discount, l_tax,
               l_returnflag, l_linestatus, cast(null as varchar) as error
        from lineitem""",
    "archive_ingest": """
        select concat('P', cast(page_id as varchar)) as cell_line,
               concat('20260122_P', cast(page_id as varchar), '_7TA_144H_paste.xlsx') as file_name,
               octet_length(encode(html)) as n_bytes, html, cast(null as varchar) as error
        from pages where page_id % 5 <> 0 and page_id % 7 <> 0""",
    "cell_ingest": """
        select 'Data analysis for IC50' as sheet, cast(1 as integer) as col, event_type as value, 's' as value_type,
               cast(null as varchar) as error
        from events
        union all
        select 'Data analysis for IC50', 2,
               case when event_id % 4 = 0 then cast(event_id // 4 as varchar) else cast(event_id / 4 as varchar) end, 'n', null
        from events""",
    "image_ingest": """
        select page_id as image_no, octet_length(encode(html)) as n_bytes, html, cast(null as varchar) as error
        from pages where octet_length(encode(html)) > 3000""",
    "archive_files": """
        select concat('P', cast(page_id as varchar)) as cell_line,
               concat('20260122_P', cast(page_id as varchar), '_7TA_144H_paste.xlsx') as file_name,
               octet_length(encode(html)) as n_bytes, html, cast(null as varchar) as error
        from pages where page_id % 5 <> 0 and page_id % 7 <> 0""",
    "archive_chunks": """
        select concat('20260122_P', cast(page_id as varchar), '_7TA_144H_paste.xlsx') as file_name, n as chunk_no,
               substr(hex(encode(html)), 2000 * n + 1, 2000) as content, cast(null as varchar) as error
        from (select *, unnest(range((octet_length(encode(html)) + 999) // 1000)) as n from pages where page_id % 5 <> 0 and page_id % 7 <> 0)""",
    "folder_walk": """
        with named as (
          select s_nationkey % 7 as place, octet_length(encode(s_name)) as length, s_suppkey,
                 concat(case s_suppkey % 4 when 0 then '_' when 1 then '.' when 2 then '~' else '' end, '20260122_S', s_suppkey,
                        case s_suppkey % 3 when 0 then '.xlsx' when 1 then '_paste.xlsx' else '_paste.csv' end) as file_name
          from supplier where s_suppkey % 4 <> 2 and s_suppkey % 3 <> 2
        )
        select case place when 0 then '1st cells' when 1 then '_b [2] cells' when 4 then '.hidden cells' else '__x cells' end as batch,
               file_name, split_part(file_name, '_', 2) as cell_line, length, 'batch' as kind
        from named where place in (0, 1, 4, 6)
        union all
        select null, file_name, split_part(file_name, '_', 2), length, 'plot' from named where place in (0, 1, 2, 3) and s_suppkey % 3 = 1""",
    "compound_places": with_(
        *TO_FIRST,
        (
            "spelt",
            """
            select distinct unnest(case when compound like '%3' then [compound, lower(compound)] else [compound] end) as compound
            from firsts where ic50_first_raw is not null""",
        ),
        select="""
        select compound, ordinal, case when row_number() over (partition by lower(compound) order by ordinal) = 1 then compound
                                       else concat(compound, '_', ordinal) end as label
        from (select compound, row_number() over (order by encode(compound)) as ordinal from spelt)""",
    ),
    "dense_readings": with_(
        *TO_FIRST,
        ("places", "select compound, row_number() over (order by encode(compound)) as ordinal from (select distinct compound from firsts where ic50_first_raw is not null)"),
        ("lines", "select distinct cell_line, batch from firsts where ic50_first_raw is not null or max_inhib_first_raw is not null"),
        select="""
        select cell_line, batch, cast(ordinal as integer) as ordinal, ic50, max_inhib
        from lines cross join places left join firsts using (cell_line, batch, compound)""",
    ),
    "palette_colors": f"""
        with placed as (
          select s_name as gene, n_regionkey as palette, s_acctbal as value,
                 (s_acctbal - min(s_acctbal) over ()) / (max(s_acctbal) over () - min(s_acctbal) over ()) as t
          from supplier join nation on s_nationkey = n_nationkey
        ), stops as (
          select n_regionkey as palette, n_nationkey::double / 24 as t0, n_nationkey * 10.0::double as a0, 255.0::double - n_nationkey * 7 as b0,
                 ((n_nationkey * 53) % 256)::double as c0
          from nation
        ), s as (
          select *, lead(t0) over w as t1, lead(a0) over w as a1, lead(b0) over w as b1, lead(c0) over w as c1, row_number() over w as n
          from stops window w as (partition by palette order by t0)
        ), held as (
          select gene, palette, value, t, greatest(least(t, (select max(t0) from s where s.palette = placed.palette)),
                                                   (select min(t0) from s where s.palette = placed.palette)) as place
          from placed
        )
        select gene, palette, value, t, {_hex([_line('place', k) for k in 'abc'])} as color
        from held join s using (palette) where (place > s.t0 or s.n = 1 and place = s.t0) and place <= s.t1""",
    "incremental_raw": """
        select s_name as compound_raw, cast(s_nationkey as varchar) as max_inhib_raw, cast(s_suppkey as varchar) as ic50_raw,
               cast(null as varchar) as error, (select count(*) from supplier where s_suppkey % 2 = 1) as n_new_rows
        from supplier""",
    "first_sheet_files": "select s_name as gene, s_acctbal as value, cast(null as varchar) as error from supplier",
    "sheet_lines": with_(
        *TO_FIRST,
        SHEET_WIDE,
        META,
        PANEL,
        CONSOLIDATED,
        select=f"""
        select cast(0 as integer) as section, cast(null as varchar) as batch, cast(null as varchar) as cell_line,
               cast(null as varchar) as assay_cell_line,
               '{BAND_LINE}' as line
        union all select 1, null, null, null, '{LABEL_LINE}'
        union all
        select 2, batch, cell_line, assay_cell_line, concat_ws(',', {SHEET_CELLS}) from consolidated""",
    ),
}
# What is written and read back is what the query without files gives.
ORACLE_SQL["bars_written"] = ORACLE_SQL["bar_ranked"]

ORACLE_SQL["sheet_pages"] = f"""
with lines as ({ORACLE_SQL["sheet_lines"]}),
numbered as (
  select *, row_number() over (order by section, encode(batch) nulls last, encode(cell_line) nulls last, encode(assay_cell_line) nulls last, encode(line)) as row_no
  from lines
)
select (row_no - 1) // 10 + 1 as page_no, min(row_no) as first_row, count(*) as n_rows, cast(sum(octet_length(encode(line)) + 1) as bigint) as n_bytes,
       {", ".join(f"arg_min_null({k}, row_no) as first_{k}, arg_max_null({k}, row_no) as last_{k}" for k in ("section", "batch", "cell_line", "assay_cell_line"))}
from numbered group by (row_no - 1) // 10 + 1"""
ORACLE_SQL["image_store"] = """
select sha256(concat(url, ' ', html)) as digest, min(2 * page_id) as first_image, 2 * count(*) as n_uses,
       any_value(octet_length(encode(concat(url, ' ', html)))) as n_bytes
from pages where url is not null and html is not null group by 1"""

"""Raw assay rows to one reading per cell line, batch and compound, then to the wide table.

Long form throughout: ``batch, cell_line, compound, ic50, max_inhib, ic50_raw, max_inhib_raw, ic50_censored, ord``.
``ord`` is the reading order, one long (see ``reading_order``): aggregates over plain numbers are hashed, those over structs
or texts have to be sorted.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from platelake.functions.identifiers import cell_line_of, id_tail
from platelake.functions.numbers import is_censored, missing_to_null, number_core, number_of_core, round2
from platelake.operators.ranking import global_rank
from platelake.session import staged

KEYS = ("cell_line", "batch", "compound")
METRICS = ("ic50", "max_inhib")
COUNTS = ("n_readings", "n_ic50_texts", "n_max_inhib_texts", "n_censored")
# Bits of a row's number in the reading order: a sheet has at most 2^20 rows.
ROW_BITS = 21


def clean_readings(raw: DataFrame) -> DataFrame:
    """``batch, file_name, compound_raw, ic50_raw, max_inhib_raw, ord`` to long readings.

    Missing-value texts become NULL. Each step refers to a computed column rather than repeating its expression, so
    the generated code stays small.
    """
    keys = ("batch", "cell_line", "compound", "ord")
    texts = raw.select(
        "batch",
        cell_line_of(F.col("file_name")).alias("cell_line"),
        id_tail(F.col("compound_raw")).alias("compound"),
        "ord",
        *[missing_to_null(F.col(f"{m}_raw")).alias(f"{m}_raw") for m in METRICS],
    )
    cores = texts.select(*texts.columns, *[number_core(F.col(f"{m}_raw")).alias(f"{m}_core") for m in METRICS])
    casts = cores.select(*cores.columns, *[F.col(f"{m}_core").try_cast("double").alias(f"{m}_cast") for m in METRICS])
    numbers = casts.select(
        *texts.columns, *[number_of_core(F.col(f"{m}_core"), F.col(f"{m}_cast")).alias(f"{m}_number") for m in METRICS]
    )
    present = numbers.select(
        *keys,
        *[F.when(~F.isnan(f"{m}_number"), F.col(f"{m}_raw")).alias(f"{m}_raw") for m in METRICS],
        *[F.when(~F.isnan(f"{m}_number"), round2(F.col(f"{m}_number"))).alias(m) for m in METRICS],
    )
    return present.select(
        "batch",
        "cell_line",
        "compound",
        *METRICS,
        *[f"{m}_raw" for m in METRICS],
        is_censored(F.col("ic50_raw")).alias("ic50_censored"),
        "ord",
    )


def _is_text(metric: str) -> Column:
    return F.col(f"{metric}_raw").isNotNull() & F.col(metric).isNull()


def rejected_values(readings: DataFrame) -> DataFrame:
    """One row per reading value that stayed text: ``batch, cell_line, compound, metric, value, ord``."""
    values = [
        F.when(_is_text(m), F.struct(F.lit(m).alias("metric"), F.col(f"{m}_raw").alias("value"))) for m in METRICS
    ]
    # No filter on the parsed columns: it would be pushed below the parsing and repeat it.
    return readings.select(
        "batch", "cell_line", "compound", "ord", F.explode(F.array_compact(F.array(*values))).alias("v")
    ).select("batch", "cell_line", "compound", "v.metric", "v.value", "ord")


def latest_names(mapping: DataFrame) -> DataFrame:
    """``ta_id, compound_name, row_no`` with the last row of each id; a NULL name is kept as a name."""
    last = F.max_by(F.struct("compound_name"), "row_no")
    return mapping.groupBy("ta_id").agg(last.alias("last")).select("ta_id", "last.compound_name")


def map_compounds(readings: DataFrame, mapping: DataFrame) -> DataFrame:
    """Replace ids by names; an id outside the map stays, an id mapped to NULL becomes NULL.

    No join hint: Spark broadcasts the list when its size is below the threshold and otherwise splits hot ids.
    """
    names = latest_names(mapping).withColumn("_hit", F.lit(True))
    named = F.when(F.col("_hit"), F.col("compound_name")).otherwise(F.col("compound"))
    return (
        readings.join(names, F.col("compound") == F.col("ta_id"), "left")
        .withColumn("compound", named)
        .select(*readings.columns)
    )


def reading_order(file_no: Column, row: Column) -> Column:
    """The order of files, then of rows in them, as one long: below the file's number the row's in ``ROW_BITS`` bits."""
    packed = F.shiftleft(file_no.cast("long"), ROW_BITS).bitwiseOR(row.cast("long"))
    return F.when((row >= 0) & (row < 1 << ROW_BITS), packed).otherwise(F.raise_error(F.lit("row number beyond the reading order")))


def counted_readings(mapped: DataFrame) -> DataFrame:
    """First value per key and metric with the counts of ``COUNTS``, also for readings without a compound.

    Values are judged on the raw value and taken by ``ord``. ``<metric>_text`` holds the winner where it is a text; both
    columns are NULL when the key has no value of that metric at all. First every key is aggregated for each of its few texts, in a
    hash table that holds numbers only; what is left of the rows is then combined per key, again in each task before
    the shuffle, so a hot key sends one row per task whatever its texts are.
    """
    texts = [F.when(_is_text(m), F.col(f"{m}_raw")).alias(f"{m}_text") for m in METRICS]
    orders = [F.when(F.col(f"{m}_raw").isNotNull(), F.col("ord")).alias(f"{m}_ord") for m in METRICS]
    rows = mapped.select(*KEYS, *METRICS, *texts, *orders, "ic50_censored")
    firsts = [c for m in METRICS for c in (F.min_by(m, f"{m}_ord").alias(m), F.min(f"{m}_ord").alias(f"{m}_at"))]
    has_text = [F.count(f"{m}_text") for m in METRICS]
    counts = [c.alias(n) for c, n in zip([F.count("*"), *has_text, F.count_if("ic50_censored")], COUNTS)]
    by_text = rows.groupBy(*KEYS, *[f"{m}_text" for m in METRICS]).agg(*firsts, *counts)
    picks = [F.min_by(F.struct(F.col(m).alias("number"), F.col(f"{m}_text").alias("text")), f"{m}_at").alias(f"_{m}") for m in METRICS]
    found = by_text.groupBy(*KEYS).agg(*picks, *[F.sum(c).alias(c) for c in COUNTS])
    columns = []
    for metric in METRICS:
        columns += [F.col(f"_{metric}.number").alias(metric), F.when(F.col(f"_{metric}.number").isNull(), F.col(f"_{metric}.text")).alias(f"{metric}_text")]
    return found.select(*KEYS, *columns, *COUNTS)


def first_readings(mapped: DataFrame) -> DataFrame:
    """The first value per key and metric of readings that have a compound."""
    found = counted_readings(mapped.filter(F.col("compound").isNotNull()))
    return found.drop(*COUNTS)


def has_value(metric: str) -> Column:
    return F.col(metric).isNotNull() | F.col(f"{metric}_text").isNotNull()


def has_any_value() -> Column:
    return has_value("ic50") | has_value("max_inhib")


def measured_compounds(mapped: DataFrame) -> DataFrame:
    """Compounds with at least one IC50 value, straight from the readings."""
    # A filter on the parsed column would be pushed below the parsing and repeat it.
    found = mapped.groupBy("compound").agg(F.bool_or(F.col("ic50_raw").isNotNull()).alias("measured"))
    return found.filter(F.col("measured") & F.col("compound").isNotNull()).select("compound")


def measured_lines(mapped: DataFrame) -> DataFrame:
    """The (cell line, batch) pairs that have any value, straight from the readings."""
    value = F.col("compound").isNotNull() & (F.col("ic50_raw").isNotNull() | F.col("max_inhib_raw").isNotNull())
    found = mapped.groupBy("cell_line", "batch").agg(F.bool_or(value).alias("measured"))
    return found.filter("measured").select("cell_line", "batch")


def compound_columns(first: DataFrame) -> list[str]:
    """Compounds with at least one IC50 value, in code-point order: the columns of the wide table."""
    names = first.filter(F.col("compound").isNotNull() & has_value("ic50")).select("compound").distinct()
    return sorted(r["compound"] for r in names.collect())


def wide_names(compounds: list[str]) -> tuple[list[str], list[str]]:
    """IC50 and inhibition column names: of compounds that differ only in case all but the first get their position added, until
    the name is free."""
    firsts: dict[str, int] = {}
    for at, compound in enumerate(compounds):
        firsts.setdefault(compound.lower(), at)
    labels = []
    for at, compound in enumerate(compounds):
        label = compound
        if firsts[compound.lower()] != at:
            label = f"{compound}_{at + 1}"
            while label.lower() in firsts:
                label = f"{label}_{at + 1}"
        labels.append(label)
    return [f"{c}_IC50" for c in labels], [f"{c}_INHIB" for c in labels]


def _quoted(name: str) -> Column:
    return F.col("`" + name.replace("`", "``") + "`")


def wide_readings(first: DataFrame, compounds: list[str], names: tuple[list[str], list[str]] | None = None) -> DataFrame:
    """One row per (cell line, batch) with any value: all IC50 columns, then all inhibition columns, numbers only.

    Partitioned by the row keys beforehand, which serves both aggregates of a pivot: one shuffle, in which a row key
    brings at most one reading per compound.
    """
    if not compounds:
        raise ValueError("no compound has an IC50 value")
    ic50_names, inhib_names = names or wide_names(compounds)
    pivoted = (
        first.filter(has_any_value())
        .repartition("cell_line", "batch")
        .groupBy("cell_line", "batch")
        .pivot("compound", compounds)
        .agg(F.first("ic50").alias("IC50"), F.first("max_inhib").alias("INHIB"))
    )
    paired = [name for pair in zip(ic50_names, inhib_names) for name in pair]
    return pivoted.toDF("cell_line", "batch", *paired).select(
        "cell_line", "batch", *map(_quoted, ic50_names), *map(_quoted, inhib_names)
    )


def compound_dictionary(first: DataFrame) -> DataFrame:
    """``compound, ordinal``: compounds with an IC50 value, numbered from 1 in code-point order by a sort over ranges."""
    names = first.filter(F.col("compound").isNotNull() & has_value("ic50")).select("compound").distinct()
    return staged(global_rank(names, F.asc("compound"), name="ordinal"))


def compound_labels(dictionary: DataFrame) -> DataFrame:
    """``compound, ordinal, label`` by the rule of ``wide_names``: of compounds that differ only in case all but the first have
    their position added, until the name is free. The names stay a table."""
    firsts = dictionary.groupBy(F.lower("compound").alias("low")).agg(F.min("ordinal").alias("least"))
    named = dictionary.join(firsts, F.lower("compound") == F.col("low"))
    done = [named.filter("ordinal = least").select("compound", "ordinal", F.col("compound").alias("label"))]
    further = F.concat_ws("_", "label", "ordinal")
    left = staged(named.filter("ordinal > least").select("compound", "ordinal", F.col("compound").alias("label")).withColumn("label", further))
    taken = firsts.select("low")
    # No two of these can meet, as each name ends in its own position.
    while not left.isEmpty():
        done.append(left.join(taken, F.lower("label") == F.col("low"), "left_anti"))
        left = staged(left.join(taken, F.lower("label") == F.col("low"), "left_semi").withColumn("label", further))
    return reduce(DataFrame.unionByName, done)


def _filled(entries: Column, n: Column, field: str, kind: str) -> Column:
    """Entries with rising ``ordinal`` to an array of ``n`` values, NULL where there is none; each entry is looked at once."""

    def step(entry, at):
        gap = entry["ordinal"] - F.coalesce(F.get(entries, at - 1)["ordinal"], F.lit(0)) - 1
        return F.concat(F.array_repeat(F.lit(None).cast(kind), gap.cast("int")), F.array(entry[field]))

    left = n - F.coalesce(F.get(entries, F.size(entries) - 1)["ordinal"], F.lit(0))
    rest = F.array(F.array_repeat(F.lit(None).cast(kind), left.cast("int")))
    return F.flatten(F.concat(F.transform(entries, step), rest))


def dense_readings(first: DataFrame, dictionary: DataFrame, texts: bool = False) -> DataFrame:
    """``cell_line, batch, ic50, max_inhib`` for each pair with any value: two arrays with a place for each compound of the dictionary.

    One table whatever the number of compounds; no name is needed to plan it. With ``texts`` the arrays hold what a sheet
    shows: a number, or the text that stands for it.
    """
    kind = "string" if texts else "double"
    values = [(F.coalesce(F.col(m).cast("string"), F.col(f"{m}_text")) if texts else F.col(m)).alias(m) for m in METRICS]
    known = dictionary.select(F.col("compound").alias("_compound"), "ordinal")
    placed = first.filter(has_any_value()).join(known, F.col("compound") == F.col("_compound"), "left")
    # An entry without a place is left out, but its line stays.
    entry = F.when(F.col("ordinal").isNotNull(), F.struct("ordinal", *values))
    lines = placed.groupBy("cell_line", "batch").agg(F.sort_array(F.collect_list(entry)).alias("_entries"))
    n = dictionary.agg(F.count("*")).scalar()
    sized = lines.withColumn("_n", n)
    return sized.select("cell_line", "batch", *[_filled(F.col("_entries"), F.col("_n"), m, kind).alias(m) for m in METRICS])


def named_columns(dense: DataFrame, compounds: list[tuple[str, int]], names: tuple[list[str], list[str]] | None = None) -> DataFrame:
    """``dense`` with a column for each of some compounds (name and ordinal) and metric in place of the arrays."""
    found = names or wide_names([c for c, _ in compounds])
    columns = [F.get(m, F.lit(at - 1)).alias(n) for m, part in zip(METRICS, found) for n, (_, at) in zip(part, compounds)]
    at = [i for i, c in enumerate(dense.columns) if c in METRICS]
    before, after = dense.columns[: at[0]], [c for c in dense.columns[at[0] :] if c not in METRICS]
    return dense.select(*map(_quoted, before), *columns, *map(_quoted, after))

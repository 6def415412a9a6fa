"""Key-value sheets to records.

A sheet row is (source_filename, row_idx, cells). Column 1 holds the label,
column 2 and 3 the values; a block of time series has the years in its header row.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.text import clean_float, clean_str, strip, year_label
from tidemark.operators.latest import first_occurrences
from tidemark.schemas import (
    EXPECTED_METRICS,
    LIQUIDITY_LABEL,
    LIQUIDITY_SERIES,
    METRICS,
    METRICS_HEADER,
    RAW_RECORD,
    RECORD_WEIGHT_FIELDS,
    SHEET_LABELS,
)

KEY_COLUMN, FIRST_VALUE = 1, 2


def strip_cells(sheet_rows: DataFrame) -> DataFrame:
    """Strip text cells and drop rows without any cell; row indexes stay."""
    cells = F.transform(
        "cells",
        lambda c: F.when(
            c["kind"] == "s", F.struct(c["kind"].alias("kind"), strip(c["text"]).alias("text"))
        ).otherwise(c),
    )
    return sheet_rows.withColumn("cells", cells).filter(
        F.exists("cells", lambda c: c.isNotNull())
    )


def last_value_per_key(
    df: DataFrame, keys: Sequence[str], order: str, values: Sequence[str]
) -> DataFrame:
    """The values of the last row per key; partial aggregates shrink big groups first."""
    last = F.max_by(F.struct(*values), order).alias("_last")
    return df.groupBy(*keys).agg(last).select(*keys, *[F.col(f"_last.{v}").alias(v) for v in values])


def pivot_last(
    df: DataFrame, keys: Sequence[str], label: str, order: str, value: Column, labels: Mapping[str, str]
) -> DataFrame:
    """One row per key with a column per label: the value of the label's last row.

    ``labels`` maps the label to the column name. Given labels need no extra job
    to find them, and one aggregation does all of them.
    """
    return df.groupBy(*keys).agg(
        *[
            F.max_by(value, F.when(F.col(label) == text, F.col(order))).alias(name)
            for text, name in labels.items()
        ]
    )


def header_unpivot(
    rows: DataFrame, headers: DataFrame, keys: Sequence[str], position: str
) -> DataFrame:
    """Values joined to the header at the same position, i.e. a real unpivot of a block."""
    return rows.join(headers, [*keys, position], "inner")


def _value(cells: Column, position: int) -> Column:
    return F.try_element_at(cells, F.lit(FIRST_VALUE + position + 1))


def _years(header: Column) -> Column:
    """Year labels of the header row up to its first empty cell."""
    values = F.slice(header, FIRST_VALUE + 1, F.greatest(F.size(header) - FIRST_VALUE, F.lit(0)))
    gap = F.array_min(F.transform(values, lambda v, i: F.when(v.isNull(), i)))
    filled = F.slice(values, F.lit(1), F.coalesce(gap, F.size(values)))
    return F.transform(filled, lambda v: year_label(v["kind"], v["text"]))


def _series(cells: Column, years: Column) -> Column:
    """Map of year to cell. Of equal years the last counts; blank text is null."""
    count = F.size(years)

    def entry(year: Column, i: Column) -> Column:
        cell = F.try_element_at(cells, i + FIRST_VALUE + 1)
        blank = (cell["kind"] == "s") & (strip(cell["text"]) == "")
        last = i == count - F.array_position(F.reverse(years), year)
        return F.struct(
            year.alias("year"), F.when(~F.coalesce(blank, F.lit(False)), cell).alias("cell"),
            last.alias("last"),
        )

    entries = F.filter(F.transform(years, entry), lambda e: e["last"])
    return F.map_from_entries(
        F.transform(entries, lambda e: F.struct(e["year"].alias("key"), e["cell"].alias("value")))
    )


def parse_records(sheet_rows: DataFrame) -> DataFrame:
    """One typed record per sheet; text cells come stripped, as the sources give them.

    Labels repeat: the last row wins, except for the liquidity label, whose first
    row is the notch adjustment and whose second is a time series.
    """
    label = F.try_element_at("cells", F.lit(KEY_COLUMN + 1))["text"]
    keyed = sheet_rows.withColumn("label", clean_str(label))
    file = ["source_filename"]
    is_liquidity = F.col("label").eqNullSafe(F.lit(LIQUIDITY_LABEL))
    numbered = first_occurrences(keyed.filter(is_liquidity), file, ["row_idx"], 2, "nth")
    nth_label = F.concat_ws(" ", "label", "nth")
    # Rows without a label stay, so that a sheet of such rows still gives a record.
    slots = keyed.filter(~is_liquidity).unionByName(
        numbered.withColumn("label", nth_label).drop("nth")
    )

    series = [m for m in EXPECTED_METRICS if m != LIQUIDITY_SERIES]
    notch, second = f"{LIQUIDITY_LABEL} 1", f"{LIQUIDITY_LABEL} 2"
    wanted = {text for text, _ in SHEET_LABELS.values()} | {*series, METRICS_HEADER, notch, second}
    is_known = F.coalesce(F.col("label").isin(sorted(wanted)), F.lit(False))
    known = F.when(is_known, F.col("label")).otherwise("")
    # Cells have no fixed size, so the aggregates sort their rows. The rows of a sheet meet
    # first: a task then sorts what the shuffle gives it, not all rows that its input unfolds to.
    rows = slots.select(*file, "row_idx", F.when(is_known, F.col("cells")).alias("cells"), known.alias("label"))
    last = last_value_per_key(rows.repartition(*file), [*file, "label"], "row_idx", ["cells"])
    # At most one row per known label is left of each sheet, so this list is short.
    wide = last.groupBy(*file).agg(
        F.map_from_entries(F.collect_list(F.struct("label", "cells"))).alias("_rows")
    )

    def row(text: str) -> Column:
        return F.element_at("_rows", F.lit(text))

    def cell(text: str, position: int) -> Column:
        value = _value(row(text), position)
        return F.when(value["kind"] == "b", F.initcap(value["text"])).otherwise(value["text"])

    fields = {}
    for name, (text, position) in SHEET_LABELS.items():
        clean = clean_float if name in RECORD_WEIGHT_FIELDS else clean_str
        fields[name] = clean(cell(text, position))
    fields["liquidity_adjustment"] = clean_str(cell(notch, 0))

    years = F.coalesce(_years(row(METRICS_HEADER)), F.array().cast("array<string>"))
    wide = wide.withColumn("_years", years)
    sources = {m: m for m in series} | {LIQUIDITY_SERIES: second}
    found = F.array(
        *[F.struct(F.lit(m).alias("m"), row(c).alias("cells")) for m, c in sorted(sources.items())]
    )
    present = F.filter(found, lambda e: e["cells"].isNotNull() & (F.size("_years") > 0))
    entries = F.transform(
        present, lambda e: F.struct(e["m"].alias("key"), _series(e["cells"], F.col("_years")).alias("value"))
    )
    fields["scope_credit_metrics"] = F.map_from_entries(entries).cast(METRICS)
    order = [f.name for f in RAW_RECORD if f.name != "source_filename"]
    return wide.select("source_filename", *[fields[n].alias(n) for n in order])

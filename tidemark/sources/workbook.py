"""Reading one sheet out of many Office Open XML workbooks.

Spark lists, splits and distributes the files; the task-side helper turns the
bytes of one workbook into rows. A workbook is limited by its format (about a
million rows), so one workbook per task call is bounded.
"""

from __future__ import annotations

import io
import posixpath
import zipfile
from collections.abc import Iterator
from xml.etree import ElementTree as ET

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.text import strip
from tidemark.schemas import CELL

# Cell texts that spreadsheet readers take as missing (fixed values).
MISSING_TEXTS = {
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
}

_REL_ID = "{http://schemas.openxmlformats.org/officeDocument/2006/relationships}id"

_ARROW_ROWS = pa.schema(
    [
        ("source_filename", pa.string()),
        ("row_idx", pa.int32()),
        ("cells", pa.list_(pa.struct([("kind", pa.string()), ("text", pa.string())]))),
    ]
)


def _local(tag: str) -> str:
    return tag.rsplit("}", 1)[-1]


def _sheet_part(book: zipfile.ZipFile, sheet: str, name: str) -> str:
    """Archive member of the named sheet."""
    target = None
    for node in ET.fromstring(book.read("xl/workbook.xml")).iter():
        if _local(node.tag) == "sheet" and node.get("name") == sheet:
            target = node.get(_REL_ID)
    if target is None:
        raise ValueError(f"{name} has no sheet named {sheet}")
    for node in ET.fromstring(book.read("xl/_rels/workbook.xml.rels")):
        if node.get("Id") == target:
            # a target is relative to xl/ or, with a leading slash, to the archive
            return posixpath.normpath(posixpath.join("xl", node.get("Target"))).lstrip("/")
    raise ValueError(f"{name} does not link sheet {sheet} to a part")


def _shared_strings(book: zipfile.ZipFile) -> list[str]:
    if "xl/sharedStrings.xml" not in book.namelist():
        return []
    root = ET.fromstring(book.read("xl/sharedStrings.xml"))
    return [_plain_text(item) for item in root if _local(item.tag) == "si"]


def _plain_text(item: ET.Element) -> str:
    """Text of a string item; phonetic runs do not belong to it."""
    out = []
    for child in item:
        if _local(child.tag) == "t":
            out.append(child.text or "")
        elif _local(child.tag) == "r":
            out += [t.text or "" for t in child if _local(t.tag) == "t"]
    return "".join(out)


def _column_of(reference: str) -> int:
    number = 0
    for ch in reference:
        if not ch.isalpha():
            break
        number = number * 26 + ord(ch.upper()) - 64
    return number - 1


def _cell_value(cell: ET.Element, shared: list[str]) -> bool | int | float | str | None:
    kind = cell.get("t", "n")
    if kind == "inlineStr":
        value = next((_plain_text(c) for c in cell if _local(c.tag) == "is"), None)
    else:
        value = next((c.text for c in cell if _local(c.tag) == "v"), None)
    if value is None:
        return None
    if kind == "n":
        number = float(value)
        return int(number) if number.is_integer() else number
    if kind == "b":
        return value == "1"
    return shared[int(value)] if kind == "s" else value


def _decode(content: bytes, sheet: str, name: str) -> dict[int, dict[int, bool | int | float | str]]:
    """Non-missing cell values of one sheet by row and column, both from zero."""
    grid: dict[int, dict[int, bool | int | float | str]] = {}
    with zipfile.ZipFile(io.BytesIO(content)) as book:
        part, shared = _sheet_part(book, sheet, name), _shared_strings(book)
        row_idx = -1
        with book.open(part) as stream:
            for _, node in ET.iterparse(stream):
                if _local(node.tag) != "row":
                    continue
                row_idx = int(node.get("r", row_idx + 2)) - 1
                col_idx = -1
                for cell in node:
                    if _local(cell.tag) != "c":
                        continue
                    reference = cell.get("r")
                    col_idx = _column_of(reference) if reference else col_idx + 1
                    value = _cell_value(cell, shared)
                    if value is None or (isinstance(value, str) and value in MISSING_TEXTS):
                        continue
                    grid.setdefault(row_idx, {})[col_idx] = value
                node.clear()
    return grid


def _sheet_rows(content: bytes, sheet: str, name: str) -> pa.RecordBatch:
    grid = _decode(content, sheet, name)
    width = 1 + max((max(row) for row in grid.values()), default=-1)
    height = 1 + max(grid, default=-1)
    # A column of numbers with a gap or a fraction holds floats throughout; a
    # column that also holds text keeps integers. The difference shows in the
    # cell text ("2.0" against "2") and so in the content hash.
    as_float = set()
    for col in range(width):
        values = [row[col] for row in grid.values() if col in row]
        numeric = all(isinstance(v, (int, float)) and not isinstance(v, bool) for v in values)
        if numeric and (len(values) < height or any(isinstance(v, float) for v in values)):
            as_float.add(col)

    def cell(col: int, value: bool | int | float | str) -> dict[str, str]:
        if isinstance(value, bool):
            return {"kind": "b", "text": "true" if value else "false"}
        if isinstance(value, str):
            return {"kind": "s", "text": value.strip()}
        return {"kind": "n", "text": repr(float(value)) if col in as_float else repr(value)}

    indexes = sorted(grid)
    cells = [
        [cell(c, grid[r][c]) if c in grid[r] else None for c in range(width)] for r in indexes
    ]
    return pa.RecordBatch.from_arrays(
        [
            pa.array([name] * len(indexes), pa.string()),
            pa.array(indexes, pa.int32()),
            pa.array(cells, _ARROW_ROWS.field("cells").type),
        ],
        schema=_ARROW_ROWS,
    )


def read_sheets(files: DataFrame, sheet: str = "MASTER") -> DataFrame:
    """Rows of the named sheet of every workbook in ``files``.

    ``files`` has ``source_filename`` and ``content``. A workbook without the
    sheet fails the job, as does one that cannot be read.
    """

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names, contents = batch.column("source_filename"), batch.column("content")
            for i in range(batch.num_rows):
                yield _sheet_rows(contents[i].as_py(), sheet, names[i].as_py())

    return files.select("source_filename", "content").mapInArrow(
        decode, "source_filename string, row_idx int, cells array<struct<kind:string,text:string>>"
    )


def sheet_rows_from_cells(cells: DataFrame) -> DataFrame:
    """Sheet rows from a long table (source_filename, row_idx, col_idx, kind, text).

    A sheet has a fixed number of columns, so one row's cells are a bounded list.
    """
    text = F.when(F.col("kind") == "s", strip(F.col("text"))).otherwise(F.col("text"))
    value = F.struct("kind", text.alias("text"))
    by_col = F.map_from_entries(F.collect_list(F.struct("col_idx", value)))
    return (
        cells.filter(F.col("text").isNotNull())
        .groupBy("source_filename", "row_idx")
        .agg(by_col.alias("m"), F.max("col_idx").alias("last"))
        .select(
            "source_filename",
            "row_idx",
            F.transform(
                F.sequence(F.lit(0), F.col("last")), lambda i: F.try_element_at("m", i)
            ).cast(f"array<{CELL.simpleString()}>").alias("cells"),
        )
    )

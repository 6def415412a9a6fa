"""Small sheets and workbooks for the tests.

The values of the four sheets are fixed values: their content hashes are known.
"""

from __future__ import annotations

import io
import zipfile
from pathlib import Path
from xml.sax.saxutils import escape

Sheet = dict[int, list]

X, Y, Z, V = 27.32900000000001, 18.4912526, 36.79999999999997, 21.53185742374875

A_1: Sheet = {
    1: ["Rated entity", "Company A"],
    2: ["CorporateSector", "Personal & Household Goods"],
    4: ["Rating methodologies applied", "General Corporate Rating Methodology",
        "Consumer Products Rating Methodology"],
    6: ["Industry risk", "Consumer Products: Non-Discretionary"],
    7: ["Industry risk score", "A"],
    8: ["Industry weight", 1],
    9: ["Segmentation criteria", "EBITDA contribution"],
    11: ["Reporting Currency/Units", "EUR"],
    12: ["Country of origin", "Federal Republic of Germany"],
    13: ["Accounting principles", "IFRS"],
    14: ["End of business year", "December"],
    17: ["Business risk profile", "B+"],
    18: ["(Blended) Industry risk profile", "A"],
    19: ["Competitive Positioning", "B+"],
    20: ["Market share", "BB-"],
    21: ["Diversification", "B+"],
    22: ["Operating profitability", "BB-"],
    23: ["Sector/company-specific factors (1)", "B-"],
    24: ["Sector/company-specific factors (2)"],
    26: ["Financial risk profile", "C"],
    27: ["Leverage", "CCC"],
    28: ["Interest cover", "B-"],
    29: ["Cash flow cover", "CCC"],
    30: ["Liquidity", "-2 notches"],
    34: ["[Scope Credit Metrics]", 2018, 2019, 2020, 2021, 2022, 2023, 2024, "2025E", "2026E", "2027E"],
    35: ["Scope-adjusted EBITDA interest cover", X, X, X, 4.862, 4.862, 4.862, Z, Z, Y, Y, "Locked"],
    36: ["Scope-adjusted debt/EBITDA", Y, Y, Y, Y, Y, Y, Z, Z, Y, Y, "Locked"],
    37: ["Scope-adjusted FFO/debt", X, X, X, Z, Z, X, X, X, X, 4.862, "Locked"],
    38: ["Scope-adjusted loan/value", X, X, X, Z, Z, "No data", X, X, X, 4.862, "Locked"],
    39: ["Scope-adjusted FOCF/debt", V, V, V, V, 4.862, 4.862, 4.862, 4.862, 4.862, 4.862, "Locked"],
    40: ["Liquidity", 4.862, 4.862, 4.862, V, V, V, V, V, V, V, "Locked"],
}

A_2: Sheet = A_1 | {
    4: ["Rating methodologies applied", "General Corporate Rating Methodology"],
    7: ["Industry risk score", "BBB"],
    17: ["Business risk profile", "B"],
    20: ["Market share", "B+"],
    22: ["Operating profitability", "B"],
    26: ["Financial risk profile", "CC"],
    37: ["Scope-adjusted FFO/debt", 22, 22, 22, Z, Z, X, 29, 29, 29, 8, "Locked"],
    40: ["Liquidity", 4.862, 4.862, 4.862, V, V, V, V, V, V, 23, "Locked"],
}

_UP = [1, 2, 2, 2, 2, 2, 2, 3, 3, 3, "Locked"]
_TWO = [1, 1, 1, 1, 3, 3, 3, 3, 3, 3, "Locked"]

B_1: Sheet = {
    1: ["Rated entity", "Company B"],
    2: ["CorporateSector", "Automobiles & Parts"],
    4: ["Rating methodologies applied",
        "Automotive and Commercial Vehicle Manufacturers Rating Methodology"],
    6: ["Industry risk", "Automotive Suppliers", "Automotive and Commercial Vehicle Manufacturers"],
    7: ["Industry risk score", "BBB", "BB"],
    8: ["Industry weight", 0.15, 0.85],
    9: ["Segmentation criteria", "EBITDA contribution"],
    11: ["Reporting Currency/Units", "CHF"],
    12: ["Country of origin", "Swiss Confederation"],
    13: ["Accounting principles", "IFRS"],
    14: ["End of business year", "March"],
    17: ["Business risk profile", "BBB"],
    18: ["(Blended) Industry risk profile", "A+"],
    19: ["Competitive Positioning", "A+"],
    20: ["Market share", "BBB+"],
    21: ["Diversification", "A-"],
    22: ["Operating profitability", "BB+"],
    23: ["Sector/company-specific factors (1)", "BBB+"],
    24: ["Sector/company-specific factors (2)"],
    26: ["Financial risk profile", "BB+"],
    27: ["Leverage", "BB+"],
    28: ["Interest cover", "A-"],
    29: ["Cash flow cover", "A-"],
    30: ["Liquidity", "+1 notch"],
    34: ["[Scope Credit Metrics]", 2019, 2020, 2021, 2022, 2023, 2024, 2025, "2026E", "2027E", "2028E"],
    35: ["Scope-adjusted EBITDA interest cover", *_UP],
    36: ["Scope-adjusted debt/EBITDA", *_UP],
    37: ["Scope-adjusted FFO/debt", *_UP],
    38: ["Scope-adjusted loan/value", 1, 2, 2, 2, 3, 3, 3, 3, 3, 3, "Locked"],
    39: ["Scope-adjusted FOCF/debt", *_TWO],
    40: ["Liquidity", *_TWO],
}

_ONES = [1, 1, 1, 1, 2, 2, 2, 3, 3, 3, "Locked"]

B_2: Sheet = B_1 | {
    8: ["Industry weight", 0.25, 0.75],
    17: ["Business risk profile", "BBB-"],
    18: ["(Blended) Industry risk profile", "A"],
    26: ["Financial risk profile", "BB"],
    28: ["Interest cover", "BBB+"],
    35: ["Scope-adjusted EBITDA interest cover", 1, 1, 1, "No data", 2, 2, 2, 3, 3, 3, "Locked"],
    36: ["Scope-adjusted debt/EBITDA", *_ONES],
    37: ["Scope-adjusted FFO/debt", *_ONES],
    38: ["Scope-adjusted loan/value", *_TWO],
}

SHEETS = {"corporates_A_1": A_1, "corporates_A_2": A_2, "corporates_B_1": B_1, "corporates_B_2": B_2}

HASHES = {
    "corporates_A_1": "b8189ffc74352721bafaa2a0be9792d42adaff4cca489bf5ebba8d94cf58cc9a",
    "corporates_A_2": "b38121183edc8221806789de43de6fc470678e525c10c9afe25883385c7c3020",
    "corporates_B_1": "861cee3eac72cc6d38b60f943a15ee215bfe1ee90fe0231d721277b02bb4fea5",
    "corporates_B_2": "73e2ed7397759498b510865535fee3949ce104ea996df36ea4521116b6542984",
}

_MAIN = "http://schemas.openxmlformats.org/spreadsheetml/2006/main"
_REL = "http://schemas.openxmlformats.org/officeDocument/2006/relationships"
_PKG = "http://schemas.openxmlformats.org/package/2006/relationships"


def _reference(row: int, col: int) -> str:
    return f"{chr(65 + col)}{row + 1}"


def workbook(sheet: Sheet, name: str = "MASTER", inline: bool = False) -> bytes:
    """A minimal workbook: an empty first sheet, then ``sheet`` from column B on."""
    shared: list[str] = []
    rows = []
    for idx, values in sheet.items():
        cells = []
        for i, value in enumerate(values):
            ref = _reference(idx, i + 1)
            if value is None:
                continue
            if isinstance(value, bool):
                cells.append(f'<c r="{ref}" t="b"><v>{int(value)}</v></c>')
            elif isinstance(value, (int, float)):
                cells.append(f'<c r="{ref}"><v>{value!r}</v></c>')
            elif inline:
                cells.append(f'<c r="{ref}" t="inlineStr"><is><t>{escape(value)}</t></is></c>')
            else:
                shared.append(value)
                cells.append(f'<c r="{ref}" t="s"><v>{len(shared) - 1}</v></c>')
        rows.append(f'<row r="{idx + 1}">{"".join(cells)}</row>')
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as book:
        book.writestr(
            "xl/workbook.xml",
            f'<workbook xmlns="{_MAIN}" xmlns:r="{_REL}"><sheets><sheet name="Cover" sheetId="1" '
            f'r:id="rId1"/><sheet name="{name}" sheetId="2" r:id="rId2"/></sheets></workbook>',
        )
        book.writestr(
            "xl/_rels/workbook.xml.rels",
            f'<Relationships xmlns="{_PKG}"><Relationship Id="rId1" Target="worksheets/sheet1.xml"/>'
            '<Relationship Id="rId2" Target="worksheets/sheet2.xml"/></Relationships>',
        )
        empty = f'<worksheet xmlns="{_MAIN}"><sheetData/></worksheet>'
        book.writestr("xl/worksheets/sheet1.xml", empty)
        book.writestr(
            "xl/worksheets/sheet2.xml",
            f'<worksheet xmlns="{_MAIN}"><sheetData>{"".join(rows)}</sheetData></worksheet>',
        )
        if not inline:
            items = "".join(f"<si><t xml:space=\"preserve\">{escape(s)}</t></si>" for s in shared)
            book.writestr("xl/sharedStrings.xml", f'<sst xmlns="{_MAIN}">{items}</sst>')
    return out.getvalue()


def write_workbooks(folder: Path, names=tuple(SHEETS)) -> None:
    folder.mkdir(parents=True, exist_ok=True)
    for name in names:
        (folder / f"{name}.xlsm").write_bytes(workbook(SHEETS[name]))

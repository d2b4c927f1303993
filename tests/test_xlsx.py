"""Spreadsheets written by hand, in the forms that programs write."""

import zipfile

import pytest

from tallyloom.sources import xlsx

MAIN = 'xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"'


def workbook(path, sheets, shared):
    with zipfile.ZipFile(path, "w") as z:
        rel = "http://schemas.openxmlformats.org/officeDocument/2006/relationships"
        names = "".join(f'<sheet name="{n}" sheetId="{k}" r:id="r{k}"/>' for k, (n, _) in enumerate(sheets, 1))
        z.writestr("xl/workbook.xml", f'<workbook {MAIN} xmlns:r="{rel}"><sheets>{names}</sheets></workbook>')
        targets = "".join(f'<Relationship Id="r{k}" Target="{"/xl/" if k == 2 else ""}worksheets/s{k}.xml"/>' for k in range(1, len(sheets) + 1))
        z.writestr("xl/_rels/workbook.xml.rels", f'<Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships">{targets}</Relationships>')
        if shared:
            z.writestr("xl/sharedStrings.xml", f"<sst {MAIN}>{''.join(shared)}</sst>")
        for k, (_, body) in enumerate(sheets, 1):
            z.writestr(f"xl/worksheets/s{k}.xml", f"<worksheet {MAIN}><sheetData>{body}</sheetData></worksheet>")


SHARED = ["<si><t>E-mail</t></si>", "<si><r><t>Am</t></r><r><t>ount</t></r><rPh sb='0' eb='1'><t>x</t></rPh></si>", "<si><t>a@b.c</t></si>", "<si><t> </t></si>"]
FIRST = (
    '<row r="1"><c r="A1" t="s"><v>0</v></c><c r="C1" t="s"><v>1</v></c><c r="D1" t="inlineStr"><is><t>Note</t></is></c></row><row r="2"/>'
    '<row r="3"><c r="A3" t="s"><v>2</v></c><c r="C3"><v>12.5</v></c></row><row r="4"><c r="AB4"><v>7</v></c></row>'
)


def test_cells_rows_and_sheets(spark, tmp_path):
    workbook(tmp_path / "a.xlsx", [("One", FIRST), ("Two", '<row r="1"><c><v>1</v></c><c t="s"><v>3</v></c></row>')], SHARED)
    workbook(tmp_path / "b.xlsx", [("One", "")], [])
    got = [(r.path.rsplit("/", 1)[1], r.sheet, r.row, r.cells) for r in xlsx.read_rows(spark, str(tmp_path)).orderBy("path", "sheet", "row").collect()]
    assert got == [
        ("a.xlsx", "One", 1, ["E-mail", None, "Amount", "Note"]), ("a.xlsx", "One", 3, ["a@b.c", None, "12.5"]), ("a.xlsx", "One", 4, [None] * 27 + ["7"]),
        ("a.xlsx", "Two", 1, ["1", " "]),
    ]


def test_a_sheet_as_a_report(spark, tmp_path):
    workbook(tmp_path / "a.xlsx", [("One", FIRST)], SHARED)
    df, unknown = xlsx.read_report(spark, str(tmp_path), "One", {"email": {"e mail"}, "amount": set()}, {"email"})
    assert [tuple(r) for r in df.collect()] == [("a@b.c", "12.5"), (None, None)] and unknown == ["Note"]
    with pytest.raises(ValueError, match="missing"):
        xlsx.read_report(spark, str(tmp_path), "One", {"email": {"e mail"}}, {"day"})
    with pytest.raises(ValueError, match="no sheet"):
        xlsx.read_report(spark, str(tmp_path), "Three", {}, set())

import pytest

from helpers import rows
from tierstar.schemas import TABLES
from tierstar.sources.delimited import accepted, file_headers, read_evolved, rejected

SPEC = TABLES["category_translation"]
ONE, TWO = (c.raw for c in SPEC.columns)


def test_files_are_read_by_their_own_headers(spark, tmp_path):
    (tmp_path / "1.csv").write_text(f"{ONE},{TWO}\nartes,art\nbebes\n")
    (tmp_path / "2.csv").write_text(f'extra,"english",{ONE}\nx,"baby, small",bebes\n,,\n1,2,3,4\n')
    (tmp_path / "3.csv").write_text(f"{ONE}\r\nflores\r\n")
    (tmp_path / "4.csv").write_text(f"extra,{TWO},extra\na,b,c\n")
    raw = read_evolved(spark, str(tmp_path), SPEC, {"english": TWO})
    assert raw.columns == [ONE, TWO, "_corrupt_record"]
    assert rows(accepted(raw), ONE, TWO) == [(None, None), (None, "b"), ("artes", "art"), ("bebes", "baby, small"), ("flores", None)]
    assert sorted(r._corrupt_record for r in rejected(raw).collect()) == ["1,2,3,4", "bebes"]
    assert {tuple(r.names) for r in file_headers(spark, str(tmp_path), ",").collect()} >= {(ONE,), ("extra", "english", ONE)}


def test_two_names_for_one_column_are_an_error(spark, tmp_path):
    (tmp_path / "1.csv").write_text(f"{ONE},old\na,b\n")
    with pytest.raises(ValueError, match="more than once"):
        read_evolved(spark, str(tmp_path), SPEC, {"old": ONE})


def test_no_files(spark, tmp_path):
    assert rows(read_evolved(spark, str(tmp_path), SPEC)) == []

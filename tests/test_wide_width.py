"""Lines of another width in a wide CSV are reported."""

import pytest

from panelforge.sources import files


def test_ragged_lines_stop_the_load(spark, tmp_path):
    (tmp_path / "w.csv").write_text("Country,2000,2001\nA,1,2\nB,3\nC,4,5,6\nD,,x\n")
    got = files.read_wide_csv(spark, str(tmp_path / "w.csv"), ["Country"])
    assert {(r["Country"], r["year"]): (r["value"], r["violation"]) for r in got.collect()} == {
        ("A", 2000): (1.0, None), ("A", 2001): (2.0, None), ("B", 2000): (None, "width"), ("B", 2001): (None, "width"),
        ("C", 2000): (None, "width"), ("C", 2001): (None, "width"), ("D", 2000): (None, None), ("D", 2001): (None, "value"),
    }
    with pytest.raises(ValueError, match="width"):
        files.fail_on(got)

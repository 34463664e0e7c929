"""The library's rules about itself."""

import re
from pathlib import Path

ROOT = Path(__file__).resolve().parent.parent


def sources():
    return [p for p in (ROOT / "panelforge").rglob("*.py") if "llm" not in p.relative_to(ROOT).parts]


def test_nothing_but_the_entry_imports_the_llm_package():
    assert [p for p in sources() if re.search(r"panelforge\.llm|from panelforge import .*llm", p.read_text())] == []


def test_no_forbidden_calls():
    for p in (ROOT / "panelforge").rglob("*.py"):
        assert not re.search(r"localCheckpoint|\.rdd\b|crossJoin\(", p.read_text()), p


def test_every_sql_has_its_query():
    import __spark_entry__ as entry

    assert set(entry.oracle_sql()) <= set(entry.queries())

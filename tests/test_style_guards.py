"""Guards on the library source: patterns the design rules out."""

import pathlib
import re

import pytest

ROOT = pathlib.Path(__file__).resolve().parents[1] / "wattspark"
SOURCES = sorted(ROOT.rglob("*.py"))

FORBIDDEN = {
    r"\.localCheckpoint\(": "lineage is cut with reliable checkpoints only",
    r"\.crossJoin\(": "no cross joins; one-row values are applied as literals",
    r"\.rdd\b": "DataFrame API only",
    r"F\.udf\(|@udf\b|functions\.udf\(": "no row-at-a-time Python UDFs (pandas UDFs only)",
}


@pytest.mark.parametrize("pattern", sorted(FORBIDDEN))
def test_library_avoids(pattern):
    hits = [f"{p.relative_to(ROOT.parent)}:{i}" for p in SOURCES
            for i, line in enumerate(p.read_text().splitlines(), 1) if re.search(pattern, line)]
    assert not hits, f"{FORBIDDEN[pattern]}: {hits}"

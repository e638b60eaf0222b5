"""House rules that a grep can check."""

import re
from pathlib import Path

PACKAGE = Path(__file__).resolve().parents[1] / "quartermill"
FORBIDDEN = {
    "crossJoin": "pair join",
    "localCheckpoint": "checkpoint that dies with an executor",
    "broadcast(": "forced broadcast",
    ".rdd": "RDD code",
    "udf": "Python function per row or batch",
    "toPandas": "whole frame on the driver",
    "applyInPandas": "Python group",
}
#: The only places that bring rows to the driver: file names, distinct header lines, rule tables (bounded), years.
COLLECTS = {"readers.py": 3, "rules.py": 1, "vintages.py": 2}


def sources():
    """The reporting library; the training-data operators have rules of their own."""
    return [p for p in sorted(PACKAGE.rglob("*.py")) if "llm" not in p.relative_to(PACKAGE).parts]


def test_no_forbidden_calls():
    for path in sources():
        text = path.read_text()
        for word, why in FORBIDDEN.items():
            assert word not in text, f"{path.name}: {word} ({why})"


def test_collects_are_bounded():
    for path in sources():
        assert path.read_text().count(".collect()") == COLLECTS.get(path.name, 0), path.name


def test_no_bare_not_isin_and_no_plain_casts_of_text():
    for path in sources():
        text = path.read_text()
        for hit in re.finditer(r"~[^\n(]*\.isin\(", text):
            assert path.name == "semantics.py", f"{path.name}: {hit.group(0)}"

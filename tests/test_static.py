"""Static guards over the library source. The training-data subpackage has its own rules and tests."""

import pathlib
import re

ROOT = pathlib.Path(__file__).resolve().parents[1] / "corate"

FORBIDDEN = {
    r"\.collect\(\)": "results pulled to the driver",
    r"\.toPandas\(\)": "results pulled to the driver",
    r"localCheckpoint": "lineage cut on executor-local storage",
    r"crossJoin": "cross join",
    r"\budf\(|pandas_udf|\.rdd\b": "Python UDF / RDD on the hot path",
}


def test_library_source_has_no_forbidden_calls():
    hits = []
    for path in ROOT.rglob("*.py"):
        if path.parent.name == "llm":
            continue
        for n, line in enumerate(path.read_text().splitlines(), 1):
            for pattern, why in FORBIDDEN.items():
                if re.search(pattern, line):
                    hits.append(f"{path.relative_to(ROOT)}:{n}: {why}: {line.strip()}")
    assert not hits, "\n".join(hits)

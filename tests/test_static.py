"""Static guards over the library source."""

from __future__ import annotations

import pathlib
import re

LIB = pathlib.Path(__file__).resolve().parent.parent / "customer360"
FORBIDDEN = {
    r"\.collect\(": "no rows pulled to the driver",
    r"\.toPandas\(": "no rows pulled to the driver",
    r"\.localCheckpoint\(": "lineage cuts must be reliable checkpoints",
    r"\budf\b|pandas_udf|mapInPandas|applyInPandas": "built-in functions only",
    r"\.rdd\.(map|flatMap|mapPartitions|foreach)": "DataFrame operators only",
    r"crossJoin": "no cross joins",
}


def test_library_source_guards():
    bad = []
    for path in LIB.rglob("*.py"):
        if "llm" in path.relative_to(LIB).parts:  # the pipeline operators have their own guards
            continue
        text = path.read_text()
        for pattern, why in FORBIDDEN.items():
            for m in re.finditer(pattern, text):
                line = text.count("\n", 0, m.start()) + 1
                bad.append(f"{path.relative_to(LIB)}:{line}: {m.group(0)} ({why})")
    assert not bad, "\n".join(bad)


def test_nothing_else_imports_the_pipeline_operators():
    for path in [*LIB.rglob("*.py"), *LIB.parent.glob("*.py")]:
        if "llm" not in path.relative_to(LIB.parent).parts and path.name not in ("__spark_entry__.py", "corpus_pipeline.py"):
            assert not re.search(r"customer360\.llm|corpus_pipeline", path.read_text()), path

"""Static guards on the library: no driver-side data paths, no Python UDFs, no local checkpoints."""

import pathlib
import re

LIB = pathlib.Path(__file__).resolve().parent.parent / "adresponse"
# the optional training-data folder has its own tests and rules
FILES = [p for p in LIB.rglob("*.py") if "llm" not in p.relative_to(LIB).parts]

FORBIDDEN = {
    r"\blocalCheckpoint\b": "lineage must be cut with a reliable checkpoint",
    r"\.toPandas\(": "no whole results through the driver",
    r"\budf\(|@F\.udf|pandas_udf|applyInPandas|mapInPandas": "cleaners and features stay native expressions",
    r"\.rdd\.(map|flatMap|mapPartitions|collect|foreach)": "DataFrame API only",
}


def test_library_avoids_slow_or_unsafe_paths():
    found = []
    for path in FILES:
        text = path.read_text()
        for pattern, why in FORBIDDEN.items():
            for m in re.finditer(pattern, text):
                found.append(f"{path.name}: {m.group(0)} ({why})")
    assert not found, found


def test_collects_are_bounded():
    """Every .collect() in the library reads an aggregate or model-sized result."""
    allowed = {
        "encoding.py",  # category dictionary: one label list per feature (model state)
        "features.py",  # NULL-presence decision: one row per feature
        "modeling.py",  # evaluation: one row per split
        "__main__.py",  # printing the search trials: one row per trial
    }
    offenders = [p.name for p in FILES if ".collect()" in p.read_text() and p.name not in allowed]
    assert not offenders, offenders

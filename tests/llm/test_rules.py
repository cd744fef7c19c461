"""What this subpackage brings to the driver is bounded whatever the corpus."""

import pathlib
import re

ROOT = pathlib.Path(__file__).resolve().parents[2] / "ledgerloom" / "llm"
ALLOWED = {
    "collocations.py": 1,  # one number: the words of the corpus
    "exact_dedup.py": 1,  # one number: the most blocks of a text
    "ngram_join.py": 1,  # FREQUENT numbers
    "fm_index.py": 2,  # block numbers; one block of the benchmark
    "langid.py": 1,  # one row of at most 64^3 counts per language
}


def test_driver_calls():
    found = {}
    for p in ROOT.glob("*.py"):
        n = len(re.findall(r"\.(?:collect|toPandas|take|head|first|toLocalIterator)\(", re.sub(r"F\.first\(|pc\.take\(", "", p.read_text())))
        if n:
            found[p.name] = n
    assert found == ALLOWED


def test_nothing_else_imports_the_subpackage():
    for p in ROOT.parent.rglob("*.py"):
        if "llm" not in p.relative_to(ROOT.parent).parts:
            assert not re.search(r"^\s*(?:from|import) .*\bllm\b", p.read_text(), re.M), p


def test_checkpoints_and_native_operator():
    text = {p.name: p.read_text() for p in ROOT.glob("*.py")}
    assert "localCheckpoint" not in "".join(text.values())
    assert not re.search(r"mapIn|applyIn|udf|\.rdd", text["exact_dedup.py"])

"""Source-level guards for the scale rules: driver-side collection only in
bounded places, no local checkpoints, no row-at-a-time Python UDFs."""

import ast
import pathlib

ROOT = pathlib.Path(__file__).resolve().parents[1] / "ledgerloom"

# (file, function) pairs allowed to bring rows to the driver, and why
ALLOWED_COLLECT = {
    ("operators/nearest.py", "_in_blocks"),             # two rows of counts
    ("operators/nearest.py", "_pruned"),                # two rows of counts, the pivots (bounded in number and bytes)
    ("operators/nearest.py", "per_cell"),               # a row per pivot
    ("plans/read_only.py", "read_only_pages"),          # the reply, a partition and a page at a time
}
DRIVER_CALLS = {"collect", "toPandas", "take", "head", "first", "toLocalIterator"}


def _calls():
    for path in ROOT.rglob("*.py"):
        if path.relative_to(ROOT).parts[0] == "llm":  # optional, has a test of its own
            continue
        tree = ast.parse(path.read_text())
        for fn in ast.walk(tree):
            if not isinstance(fn, (ast.FunctionDef, ast.AsyncFunctionDef)):
                continue
            for node in ast.walk(fn):
                if isinstance(node, ast.Call) and isinstance(node.func, ast.Attribute):
                    recv = node.func.value
                    if isinstance(recv, ast.Name) and recv.id == "F":
                        continue  # pyspark.sql.functions (F.first is an aggregate)
                    yield str(path.relative_to(ROOT)), fn.name, node.func.attr


def test_driver_side_collection_only_where_bounded():
    offenders = {(f, fn, a) for f, fn, a in _calls() if a in DRIVER_CALLS and (f, fn) not in ALLOWED_COLLECT}
    assert not offenders, offenders


def test_no_local_checkpoint_and_no_row_udf():
    text = "\n".join(p.read_text() for p in ROOT.rglob("*.py"))
    assert "localCheckpoint" not in text
    assert "F.udf(" not in text and "@udf" not in text and "functions.udf" not in text

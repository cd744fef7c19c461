"""Links of the n-gram join hold whatever ids the rows have."""

import pytest

from ledgerloom.llm import ngram_join
from ledgerloom.llm.common import ship

WORDS = [f"w{i}" for i in range(100)]
CHAIN = [" ".join([*WORDS, *extra]) for extra in ([], ["x1", "x2", "x3", "x4", "x5", "x6", "x7", "x8"],
                                                  [f"x{i}" for i in range(1, 22)], [f"x{i}" for i in range(1, 36)])]
APART = " ".join(f"v{i}" for i in range(50))


@pytest.mark.parametrize("small,block", [(64, 512), (1, 2)])
@pytest.mark.parametrize("kind,ids,want", [
    ("bigint", [1, None, 3, None, 9], [1, 1, 1, 1, 9]),  # the null rows are the chain's joints
    ("bigint", [None, None, None, None, 2], [None, None, None, None, 2]),
    ("bigint", [5, 5, 4, 6, 5], [4, 4, 4, 4, 5]),  # repeated ids with different texts
    ("string", ["p9", None, "p10", "p2", "x"], ["p10", "p10", "p10", "p10", "x"]),
    ("decimal(20,0)", [10 ** 19, None, 2 * 10 ** 19 - 1, 10 ** 19 + 1, 7], [10 ** 19] * 4 + [7]),
])
def test_null_repeated_and_other_ids_lose_no_link(spark, kind, ids, want, small, block):
    ship(spark)
    rows = list(zip([None if i is None else str(i) for i in ids], [*CHAIN, APART], range(5)))
    docs = spark.createDataFrame([*rows, rows[1]], "id string, text string, place int").repartition(3)
    docs = docs.selectExpr(f"CAST(id AS {kind}) AS doc_id", "text", "place AS node")
    got = sorted((r.n_shingles, str(r.component_id)) for r in ngram_join.near_duplicates(docs, small=small, block=block).collect())
    sizes = [len(t.split()) - 3 for t in [*CHAIN, APART]]
    pairs = list(zip(sizes, map(str, want)))
    assert got == sorted([*pairs, pairs[1]])

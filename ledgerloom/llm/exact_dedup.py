"""Exact dedup by deterministic block naming.

A text is cut into fixed-size blocks. Equal blocks get one integer name (the
distinct blocks are sorted and numbered), then adjacent pairs of names are
named in the same way until one name is left: texts of one length have equal
names exactly when they are equal, without trusting any hash.

Naming is lazy. The first round names (length, first block) alone; a document
whose name is unique there has its identity already, and only the others have
their remaining blocks named. Names are handed back by joins whose two sides
are plain shuffles of stored tables, so adaptive execution can split a block
that a third of all rows share. Native DataFrame operations only.

Defined results: a null text counts as empty; empty texts equal each other; a
null id is carried, is never the smallest of a group that has another id, and
is kept only when no row of its group has an id. Rows that repeat both id and
text each count in ``group_size`` and share one decision. An empty table gives
an empty result; other columns of the input are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import store

#: Code points of the first block, named in the first round, and of all blocks after it.
HEAD = 64
BLOCK = 1024


def normalised(text: Column) -> Column:
    """Every run of blanks becomes one space; a lone space is left as it is."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), r"[\x09-\x0D][\x20\x09-\x0D]*|\x20[\x20\x09-\x0D]+", " ")


def _named(values: DataFrame, keys: list[str], label: str) -> DataFrame:
    """One integer for each distinct combination of ``keys``: sorted, then numbered."""
    return store(
        values.select(*keys).distinct().sortWithinPartitions(*keys).withColumn("name", F.monotonically_increasing_id()),
        label)


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256."""
    texts = docs.select(F.col(id_col).alias("doc_id"), normalised(F.col(text_col)).alias("body")).withColumn(
        "n", F.length("body")).withColumn("head", F.substring("body", 1, HEAD))
    slim = store(texts.select("doc_id", F.sha2(F.col("body"), 256).alias("sha"), "n", "head"), "dedup-slim")
    shared = store(slim.groupBy("n", "head").count().where("count > 1").select("n", "head"), "dedup-heads")

    single = slim.join(shared, ["n", "head"], "left_anti").select(
        "doc_id", F.col("doc_id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"),
        F.lit(True).alias("kept"), F.col("sha").alias("text_sha256"))

    rest = slim.join(shared, ["n", "head"], "left_semi").select("doc_id", "sha", "n")
    ident = _identities(texts.join(shared.hint("merge"), ["n", "head"], "left_semi"))
    rows = store(rest.alias("r").join(
        ident.alias("i"),
        F.col("r.doc_id").eqNullSafe(F.col("i.doc_id")) & (F.col("r.sha") == F.col("i.sha")) & (F.col("r.n") == F.col("i.n")))
        .select("r.doc_id", "r.sha", "r.n", "i.name"), "dedup-rows")
    groups = store(rows.groupBy("n", "name").agg(F.min("doc_id").alias("keep_id"), F.count("*").alias("group_size")),
                   "dedup-groups")
    copies = rows.join(groups, ["n", "name"]).select(
        "doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"),
        F.col("sha").alias("text_sha256"))
    return single.unionByName(copies)


def _identities(texts: DataFrame) -> DataFrame:
    """(doc_id, sha, n, name): equal (n, name) exactly for equal texts."""
    blocks = store(
        texts.select("doc_id", F.sha2(F.col("body"), 256).alias("sha"), "n",
                     F.posexplode(F.when(F.col("n") == 0, F.array(F.lit(""))).otherwise(
                         F.regexp_extract_all("body", F.lit(f"(?s).{{1,{BLOCK}}}"), F.lit(0)))).alias("at", "block")),
        "dedup-blocks")
    level = store(blocks.join(_named(blocks, ["block"], "dedup-names"), "block").select("doc_id", "sha", "n", "at", "name"),
                  "dedup-level")
    last = level.agg(F.max("at")).first()[0] or 0
    while last > 0:
        even = F.col("at") % 2 == 0
        pairs = store(
            level.groupBy("doc_id", "sha", "n", F.floor(F.col("at") / 2).cast("int").alias("at")).agg(
                F.max(F.when(even, F.col("name"))).alias("left"),
                F.coalesce(F.max(F.when(~even, F.col("name"))), F.lit(-1)).alias("right")), "dedup-pairs")
        level = store(pairs.join(_named(pairs, ["left", "right"], "dedup-names"), ["left", "right"]).select(
            "doc_id", "sha", "n", "at", "name"), "dedup-level")
        last //= 2
    return level.select("doc_id", "sha", "n", "name").distinct()


ORACLE_SQL = r"""
WITH t AS (
  SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS body FROM documents
), g AS (
  SELECT body, min(doc_id) AS keep_id, count(*) AS group_size FROM t GROUP BY body
)
SELECT t.doc_id, g.keep_id, g.group_size, t.doc_id IS NOT DISTINCT FROM g.keep_id AS kept, sha256(t.body) AS text_sha256
FROM t JOIN g ON t.body = g.body
"""

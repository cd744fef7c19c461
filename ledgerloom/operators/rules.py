"""Substring rules as an equi-join on rare grams.

A text can only hold a pattern if it holds every three-character gram of it.
So each pattern is filed under the one of its grams that the fewest texts
have, texts meet patterns by that gram, and the pattern itself is looked for
in the few texts that it meets. Patterns that have a gram which no text has
drop out before the join. Rules and texts are both tables of any size: nothing
is collected, inlined or broadcast by hand, and one plan serves a dozen rules
as well as millions. Small rule sets are broadcast by Spark's own estimate.

Texts are matched once per distinct text, and results go back by text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Characters of a gram; shorter patterns are filed under themselves.
GRAM = 3

# The catch-all transfer word patterns of the transaction model.
TRANSFER_WORD_PATTERNS = [r"(^|\s)transfer(\s|$|sent|received)", r"(^|\s)tf\d"]


def _text_grams(sizes: Column) -> Column:
    """Distinct grams of ``text`` in the sizes that patterns ask for."""
    kinds = [F.when(F.array_contains(sizes, n) & (F.length("text") >= n), F.expr(
        f"transform(sequence(1, length(text) - {n - 1}), i -> substring(text, i, {n}))")) for n in range(1, GRAM + 1)]
    kinds.append(F.when(F.array_contains(sizes, 0), F.array(F.lit(""))))
    return F.array_distinct(F.flatten(F.array_compact(F.array(*kinds))))


def _literal(pattern: str) -> Column:
    """The longest part of a LIKE pattern that holds no wildcard or escape."""
    runs = F.transform(F.split(pattern, r"[%_\\]+"), lambda r: F.struct(F.length(r).alias("n"), r.alias("run")))
    return F.array_max(runs)["run"]


def rule_hits(texts: DataFrame, rules: DataFrame, like: bool = False) -> DataFrame:
    """Every pair of a distinct ``text`` of ``texts`` and a row of ``rules`` whose ``pattern`` it holds.

    With ``like`` the pattern may hold LIKE wildcards and matches anywhere in
    the text. A null text or pattern matches nothing, an empty pattern all.
    """
    texts = texts.select("text").filter(F.col("text").isNotNull()).distinct()
    patterns = (rules.select("pattern").filter(F.col("pattern").isNotNull()).distinct()
                .withColumn("core", _literal("pattern") if like else F.col("pattern"))
                .withColumn("size", F.least(F.length("core"), F.lit(GRAM))))
    sizes = patterns.agg(F.collect_set("size")).scalar()  # at most GRAM + 1 numbers
    grams = texts.select("text", F.explode(_text_grams(sizes)).alias("gram"))
    asked = patterns.select("pattern", F.explode(F.array_distinct(F.expr(
        "transform(sequence(1, length(core) - size + 1), i -> substring(core, i, size))"))).alias("gram"), "size", "core")
    common = grams.join(asked.select("gram").distinct(), "gram", "left_semi").groupBy("gram").agg(F.count("*").alias("times"))
    # A pattern with a gram that no text has is in no text.
    filed = (asked.join(common, "gram", "left").groupBy("pattern")
             .agg(F.min_by("gram", F.struct("times", "gram")).alias("gram"), F.max(F.col("times").isNull()).alias("absent"))
             .filter(~F.col("absent")).select("gram", "pattern"))
    found = F.like(F.col("text"), F.concat(F.lit("%"), "pattern", F.lit("%"))) if like else F.contains(F.col("text"), F.col("pattern"))
    return grams.join(filed, "gram").filter(found).select("text", "pattern").join(rules, "pattern")


def first_rule(texts: DataFrame, rules: DataFrame, order: list[str], value: str) -> DataFrame:
    """(text, value): of the rules that each text matches, the first by ``order``; texts without one are left out."""
    hits = rule_hits(texts, rules)
    return hits.groupBy("text").agg(F.min(F.struct(*order, value))[value].alias(value))


def categorised(texts: DataFrame, transfer_rules: DataFrame, category_rules: DataFrame) -> DataFrame:
    """B8 and B9 per distinct text: whether a transfer rule matches, and the first other category by (priority, rule_id)."""
    usable = category_rules.filter(F.col("category_id").isNotNull() & F.col("priority").isNotNull())
    nothing = F.lit(None)
    rules = usable.select(
        "pattern", (F.col("category_id") == "transfer").alias("transfer"),
        F.when(F.col("category_id") != "transfer", F.struct(F.col("priority").cast("int").alias("priority"), "rule_id", "category_id")).alias("rule"))
    rules = rules.unionByName(transfer_rules.select("pattern", F.lit(True).alias("transfer"), nothing.cast(
        rules.schema["rule"].dataType).alias("rule")))
    return rule_hits(texts, rules).groupBy("text").agg(
        F.max("transfer").alias("transfer_rule"), F.min("rule")["category_id"].alias("first_category"))


def transfer_words(clean: Column) -> Column:
    """The catch-all word patterns; null for a null text."""
    cond = clean.rlike(TRANSFER_WORD_PATTERNS[0])
    for p in TRANSFER_WORD_PATTERNS[1:]:
        cond = cond | clean.rlike(p)
    return cond

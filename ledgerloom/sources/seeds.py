"""Hand-kept seed files: typed CSV tables.

Every column of a seed that is declared below is read as that type; columns
that are not declared get the type that Spark infers from the file. A value
that its declared type cannot hold, or a line with too few or too many fields,
does not stop the load: the line goes to the rejects with the field and the
reason, and is not part of the table.

Defined results: an empty field is null, a quoted field may hold commas and
line breaks, a file with nothing but its header is an empty table of strings
(declared columns keep their type), a declared column that the file lacks is
an error of the whole file and raises ``ValueError``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The seeds and the column types they declare.
SEED_TYPES: dict[str, dict[str, str]] = {
    "dim_account_normalization": {"account_id": "string", "friendly_name": "string", "inversion_factor": "int",
                                  "is_active": "boolean", "expected_frequency": "string", "start_date": "date"},
    "dim_holders": {"holder_raw": "string", "owner": "string"},
    "dim_category_overrides": {"stable_id": "string", "category_id": "string", "notes": "string"},
    "dim_transfer_rules": {"rule_id": "string", "pattern": "string", "direction": "string", "notes": "string"},
    "dim_category_rules": {},
    "dim_categories": {},
}
#: Seeds whose lines are taken in file order.
ORDERED = {"dim_category_rules"}
REJECT_COLUMNS = ["seed", "field", "value", "reason"]
_BROKEN = "_broken_line"
_OPTIONS = {"header": "true", "multiLine": "true", "escape": '"', "dateFormat": "yyyy-MM-dd"}


def _typed(column: str, kind: str) -> Column:
    return F.col(f"`{column}`").try_cast(kind).alias(column)


def read_seed(spark: SparkSession, path: str, name: str, types: dict[str, str] | None = None) -> tuple[DataFrame, DataFrame]:
    """(rows, rejects) of the seed file or folder ``path``; rejects has one row per wrong value or line."""
    declared = SEED_TYPES.get(name, {}) if types is None else types
    inferred = spark.read.options(**_OPTIONS, inferSchema="true").csv(path).schema
    missing = [c for c in declared if c not in inferred.fieldNames()]
    if missing:
        raise ValueError(f"seed {name}: no column {', '.join(missing)}")
    text = T.StructType([T.StructField(f.name, T.StringType()) for f in inferred] + [T.StructField(_BROKEN, T.StringType())])
    lines = spark.read.options(**_OPTIONS, columnNameOfCorruptRecord=_BROKEN).schema(text).csv(path)
    # every field is read, whichever columns a query takes: Spark judges a line by the fields that it parses
    lines = lines.where(F.length(F.concat_ws("", *[F.col(f"`{f.name}`") for f in inferred])) >= 0)

    kinds = {f.name: declared.get(f.name, f.dataType.simpleString()) for f in inferred}
    wrong = [F.when(F.col(f"`{c}`").isNotNull() & F.col(f"`{c}`").try_cast(kind).isNull(),
                    F.struct(F.lit(c).alias("field"), F.col(f"`{c}`").alias("value"), F.lit(f"not {kind}").alias("reason")))
             for c, kind in kinds.items() if kind != "string"]
    broken = F.when(F.col(_BROKEN).isNotNull(), F.struct(
        F.lit(None).cast("string").alias("field"), F.col(_BROKEN).alias("value"), F.lit("wrong number of fields").alias("reason")))
    # a line of the wrong length has its fields in the wrong places, so only the line is reported
    issues = F.when(F.col(_BROKEN).isNotNull(), F.array(broken)).otherwise(F.array_compact(F.array(*wrong) if wrong else F.array(broken)))
    judged = lines.withColumn("_issues", issues)
    rows = judged.where(F.size("_issues") == 0).select(*[_typed(c, kind) for c, kind in kinds.items()])
    rejects = judged.select(F.explode("_issues").alias("i")).select(F.lit(name).alias("seed"), "i.field", "i.value", "i.reason")
    return rows, rejects


def read_seeds(spark: SparkSession, folder: str, names: list[str] | None = None) -> tuple[dict[str, DataFrame], DataFrame]:
    """({name: rows}, rejects of all) of ``folder/<name>.csv``; ``line`` numbers the rows where their order counts."""
    rows, rejects = {}, None
    for name in names or SEED_TYPES:
        rows[name], bad = read_seed(spark, f"{folder.rstrip('/')}/{name}.csv", name)
        if name in ORDERED:  # a file is read by one task, in its order
            rows[name] = rows[name].withColumn("line", F.monotonically_increasing_id())
        rejects = bad if rejects is None else rejects.unionByName(bad)
    return rows, rejects


def write_seed(rows: DataFrame, folder: str, name: str) -> None:
    """A seed as a CSV folder that ``read_seed`` takes."""
    rows.write.mode("overwrite").options(header="true", escape='"', dateFormat="yyyy-MM-dd").csv(f"{folder.rstrip('/')}/{name}.csv")

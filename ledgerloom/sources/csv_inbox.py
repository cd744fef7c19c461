"""Bank/card CSV exports (A10): headers vary per bank, so columns are found
through alias sets; rows are validated and typed with built-in expressions.

Input is text lines with their file and a line position (0 = header): the
batch reader (``read_inbox``) and the streaming inbox (``streaming.inbox``)
both read the splittable line source, so a large file is spread over many
tasks like any other input.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import with_once

# Header aliases (lower-cased, trimmed). When several aliases
# of one role are present the reference's pick is arbitrary (set order); we
# take them in this order.
DATE_ALIASES = ["date", "transaction date", "posted date", "trans. date"]
DESCRIPTION_ALIASES = ["description", "details", "transaction details", "memo", "narration"]
AMOUNT_ALIASES = ["amount", "debit", "credit", "transaction amount", "cad$"]
BOM = "\ufeff"


def record_fields(line: Column) -> Column:
    """Fields of one CSV record, however many: a field in double quotes may
    hold commas and doubled quotes."""
    raw = F.regexp_extract_all(F.concat(F.lit(","), line), F.lit(r',("[^"]*+(?:""[^"]*+)*+"|[^,]*+)'), F.lit(1))
    quoted = r'(?s)^"(.*)"$'
    return F.transform(raw, lambda f: F.when(f.rlike(quoted), F.replace(
        F.regexp_extract(f, quoted, 1), F.lit('""'), F.lit('"'))).otherwise(f))


def stripped(c: Column) -> Column:
    """Without white space at either end, line breaks and tabs included."""
    return F.regexp_replace(c, r"^\s+|\s+$", "")


def _first_alias(names: Column, aliases: list[str]) -> Column:
    """1-based position of the first alias present in ``names`` (0 if none)."""
    pos = [F.array_position(names, a) for a in aliases]
    return F.coalesce(*[F.when(p > 0, p) for p in pos], F.lit(0)).cast("int")


def parse_lines(lines: DataFrame, landed_at: Column) -> tuple[DataFrame, DataFrame]:
    """lines(source_file, line_no, text) -> (rows, rejected).

    rows: source_file, landed_at, row_date, description, amount, account_hint
    rejected: source_file, line_no, text, reason — nothing is dropped silently.
    A file whose header lacks a date, description or amount column yields
    no rows; all its lines are rejected with reason 'unrecognised_header'.
    """
    header = (lines.filter(F.col("line_no") == 0)
              .select("source_file",
                      F.transform(record_fields(F.regexp_replace("text", "^" + BOM, "")),
                                  lambda h: F.lower(stripped(h))).alias("names")))
    roles = header.select(
        "source_file",
        _first_alias(F.col("names"), DATE_ALIASES).alias("date_pos"),
        _first_alias(F.col("names"), DESCRIPTION_ALIASES).alias("desc_pos"),
        _first_alias(F.col("names"), AMOUNT_ALIASES).alias("amount_pos"),
    )
    body = lines.filter((F.col("line_no") > 0) & (F.length(F.trim("text")) > 0))
    j = body.join(roles, "source_file", "left")
    j = with_once(j, record_fields(F.col("text")), "_f")  # each line is parsed once

    def pick(pos):
        return F.when(F.col(pos) > 0, F.get(F.col("_f"), F.col(pos) - 1))

    raw_date = stripped(pick("date_pos"))
    raw_amount = F.regexp_replace(stripped(pick("amount_pos")), "[,$]", "")
    desc = stripped(pick("desc_pos"))
    parsed = j.select(
        "source_file", "line_no", "text",
        F.coalesce((F.col("date_pos") > 0) & (F.col("desc_pos") > 0) & (F.col("amount_pos") > 0),
                   F.lit(False)).alias("known"),
        F.when(raw_date.rlike(r"^\d{4}-\d{2}-\d{2}$"), F.try_to_date(raw_date, "yyyy-MM-dd"))
         .when(raw_date.rlike(r"^\d{8}$"), F.try_to_date(raw_date, "yyyyMMdd")).alias("row_date"),
        raw_date.alias("raw_date"),
        F.when(raw_amount != "", raw_amount.try_cast("decimal(12,2)")).alias("amount"),
        raw_amount.alias("raw_amount"),
        F.when(desc != "", desc).alias("description"),
    )
    reason = (F.when(~F.col("known"), F.lit("unrecognised_header"))
               .when(F.col("raw_date").isNull() | (F.col("raw_date") == ""), F.lit("blank_date"))
               .when(F.col("raw_amount").isNull() | (F.col("raw_amount") == ""), F.lit("blank_amount"))
               .when(F.col("row_date").isNull(), F.lit("bad_date"))
               .when(F.col("amount").isNull(), F.lit("bad_amount")))
    tagged = parsed.withColumn("reason", reason)
    stem = F.regexp_replace(F.element_at(F.split("source_file", "/"), -1), r"(?<=.)\.[^.]*$", "")
    rows = tagged.filter(F.col("reason").isNull()).select(
        F.element_at(F.split("source_file", "/"), -1).alias("source_file"),
        landed_at.alias("landed_at"), "row_date", "description", "amount",
        stem.alias("account_hint"))
    rejected = tagged.filter(F.col("reason").isNotNull()).select("source_file", "line_no", "text", "reason")
    return rows, rejected


# --- records over physical lines --------------------------------------------------------

# Complete fields of a line, each with its comma; a quote opens a field only at
# its start, two in a quoted field stand for one, and text behind the closing
# quote belongs to the field. Then a quoted field that the line does not close.
_QUOTED = r'[^"]*+(?:""[^"]*+)*+'
_FIELDS = rf'(?:"{_QUOTED}"[^,]*+,|(?!")[^,]*+,)*+'
OPENS = rf'^{_FIELDS}"{_QUOTED}$'
STAYS_OPEN = rf'^{_QUOTED}(?:"[^,]*+,{_FIELDS}"{_QUOTED})?$'


def _after(last_fixed: Column, flips: Column, start: Column) -> Column:
    """State behind some lines: the last fixed state or else ``start``, turned by the flips since."""
    since = flips - F.coalesce(last_fixed["flips"], F.lit(0))
    return F.coalesce(last_fixed["open"], start) != (since % 2 == 1)


def _carried(lines: DataFrame) -> DataFrame:
    """lines(file_path, block_start, lid, text, ...) with ``before`` and ``after``: whether a
    quoted field is open where the line starts and where it ends.

    What a line does to that state is one of four functions: it keeps it, flips
    it, or ends open or closed whatever it was. Functions of neighbouring lines
    compose, so each split is scanned on its own, the splits of a file are
    scanned by one row each, and the state at a split's start goes back in.
    """
    opens, stays = F.col("text").rlike(OPENS), F.col("text").rlike(STAYS_OPEN)
    t = lines.withColumn("_fixed", F.when(opens == stays, opens)).withColumn("_flip", (opens & ~stays).cast("long"))
    split = Window.partitionBy("file_path", "block_start").orderBy("lid")
    t = t.withColumn("_flips", F.sum("_flip").over(split.rowsBetween(Window.unboundedPreceding, 0)))
    state = F.when(F.col("_fixed").isNotNull(), F.struct(F.col("_fixed").alias("open"), F.col("_flips").alias("flips")))
    t = t.withColumn("_last", F.last(state, ignorenulls=True).over(split.rowsBetween(Window.unboundedPreceding, 0)))

    whole = t.groupBy("file_path", "block_start").agg(F.max_by("_last", "lid").alias("_last"), F.max_by("_flips", "lid").alias("_flips"))
    earlier = Window.partitionBy("file_path").orderBy("block_start").rowsBetween(Window.unboundedPreceding, -1)
    whole = whole.withColumn("_before_flips", F.coalesce(F.sum("_flips").over(earlier), F.lit(0)))
    reset = F.when(F.col("_last").isNotNull(), F.struct(F.col("_last.open").alias("open"), (F.col("_before_flips") + F.col("_last.flips")).alias("flips")))
    starts = whole.withColumn("_reset", reset).withColumn("_reset", F.last("_reset", ignorenulls=True).over(earlier)).select(
        "file_path", "block_start", _after(F.col("_reset"), F.col("_before_flips"), F.lit(False)).alias("_start"))
    t = t.join(starts, ["file_path", "block_start"])
    t = t.withColumn("after", _after(F.col("_last"), F.col("_flips"), F.col("_start")))
    return t.withColumn("before", F.coalesce(F.lag("after").over(split), F.col("_start"))).select(*lines.columns, "before", "after")


def _assembled(lines: DataFrame) -> DataFrame:
    """Records of the lines: a record begins where no quoted field is open and
    takes the lines up to its end, joined by line breaks. Only lines of records
    that span several are brought together; a record over a split border is
    found by the last record start of the splits before."""
    t = _carried(lines)
    split = Window.partitionBy("file_path", "block_start").orderBy("lid")
    begins = F.when(~F.col("before"), F.struct("block_start", "lid"))
    t = t.withColumn("_begin", F.last(begins, ignorenulls=True).over(split.rowsBetween(Window.unboundedPreceding, 0)))
    last = t.groupBy("file_path", "block_start").agg(F.max(begins).alias("_last_begin"))
    earlier = Window.partitionBy("file_path").orderBy("block_start").rowsBetween(Window.unboundedPreceding, -1)
    carried = last.select("file_path", "block_start", F.last("_last_begin", ignorenulls=True).over(earlier).alias("_carried"))
    t = t.join(carried, ["file_path", "block_start"]).withColumn("_begin", F.coalesce("_begin", "_carried"))
    single = t.filter(~F.col("before") & ~F.col("after")).select(*lines.columns)
    parts = t.filter(F.col("before") | F.col("after")).groupBy("file_path", "source_file", "_begin").agg(
        F.sort_array(F.collect_list(F.struct("block_start", "lid", "text"))).alias("_lines"))
    joined = parts.select("file_path", "source_file", F.col("_begin.block_start").alias("block_start"),
                          F.concat_ws("\n", F.col("_lines.text")).alias("text"), F.col("_begin.lid").alias("lid"))
    return single.unionByName(joined)


def lines_of_text(raw: DataFrame) -> DataFrame:
    """raw(file_path, source_file, block_start, text) — lines from the
    splittable text source — to records (source_file, line_no, text).

    Row ids come from ``monotonically_increasing_id`` (partition index +
    position, both fixed by the file splits, so a retried task reproduces
    them); (block_start, row id) orders a file's lines. Files without a quoted
    line break keep their lines as they are; only the others go through the
    scan of quotes (``_assembled``).

    A file's header is its first record, in whichever split it lies (an export
    may begin anywhere in a bundle). The header pick is a partial
    aggregate per file, so no file — however large — is ever gathered into one
    task; a body record gets ``line_no`` > 0 (its row id, not its number)."""
    t = raw.select("file_path", "source_file", "block_start", "text",
                   F.monotonically_increasing_id().alias("lid"))
    broken = t.filter(F.col("text").rlike(OPENS)).select("file_path").distinct()
    records = t.join(broken, "file_path", "left_anti").unionByName(
        _assembled(t.join(broken, "file_path", "left_semi").select(*t.columns)))
    first = (records.groupBy(F.col("file_path").alias("_fp"))
             .agg(F.min(F.struct("block_start", "lid"))["lid"].alias("_hid")))
    j = records.join(first, records.file_path == first._fp, "left")
    return j.select("source_file",
                    F.when(F.col("lid") == F.col("_hid"), F.lit(0).cast("bigint"))
                     .otherwise(F.col("lid") + 1).alias("line_no"),
                    "text")


def raw_text_columns(df: DataFrame) -> DataFrame:
    """Text-source rows -> (file_path, source_file, block_start, text); the
    file name is the partition value ``source_file`` when the inbox is laid
    out by name, else the path's last component."""
    name = (F.col("source_file") if "source_file" in df.columns
            else F.element_at(F.split(F.col("_metadata.file_path"), "/"), -1))
    return df.select(F.col("_metadata.file_path").alias("file_path"), name.alias("source_file"),
                     F.col("_metadata.file_block_start").alias("block_start"), F.col("value").alias("text"))


def bundled_lines(lines: DataFrame) -> DataFrame:
    """lines(source_file, text), in order -> (value): the physical lines as ``from_bundle`` reads them, each behind its
    export's name and a tab. They stay whole wherever a bundle is split."""
    parts = F.split(F.regexp_replace(F.coalesce("text", F.lit("")), r"\r\z", ""), "\r\n|\r|\n", -1)
    name = F.concat(F.coalesce(F.url_encode("source_file"), F.lit("")), F.lit("\t"))
    return lines.select(name.alias("name"), F.explode(parts).alias("part")).select(F.concat("name", "part").alias("value"))


def from_bundle(df: DataFrame) -> DataFrame:
    """Text-source rows of bundles -> the columns of ``raw_text_columns``; an export is a file of its own."""
    name = F.substring_index("value", "\t", 1)
    return df.select(F.concat(F.col("_metadata.file_path"), F.lit("#"), name).alias("file_path"),
                     F.url_decode(F.nullif(name, F.lit(""))).alias("source_file"),
                     F.col("_metadata.file_block_start").alias("block_start"),
                     F.expr("substring(value, locate('\\t', value) + 1)").alias("text"))


def read_inbox(spark: SparkSession, path_glob: str) -> DataFrame:
    """Batch reader over the splittable text source."""
    return lines_of_text(raw_text_columns(spark.read.text(path_glob)))


# --- fixture: raw export lines from the driver tables ----------------------------------

# Fixed values of the fixture: header variants by customer key % 4 (3 is
# an unrecognised header) and the row defects by order key % 20.
HEADER_VARIANTS = [
    "Date,Description,Amount",
    '"Details","Transaction Date" ,"CAD$"',
    BOM + "Posted Date,Memo,Transaction Amount",
    "When,What,How Much",
]


def export_lines(customer: DataFrame, bank_src: DataFrame) -> DataFrame:
    """(source_file, line_no, text): one export file per customer account."""
    hdr = customer.select(
        F.concat(F.lit("A"), F.col("c_custkey").cast("string"), F.lit(".csv")).alias("source_file"),
        F.lit(0).cast("bigint").alias("line_no"),
        F.element_at(F.array(*[F.lit(h) for h in HEADER_VARIANTS]), (F.col("c_custkey") % 4 + 1).cast("int"))
         .alias("text"))
    amt = (F.col("tc") / 100).cast("decimal(18,2)")
    plain = amt.cast("string")
    k = F.col("o_orderkey") % 20
    amount_text = (F.when(k == 0, F.concat(F.lit('"'), F.format_number(amt, 2), F.lit('"')))
                    .when(k == 1, F.concat(F.lit("$"), plain))
                    .when(k == 2, F.concat(F.lit("("), plain, F.lit(")")))
                    .when(k == 4, F.lit(""))
                    .otherwise(plain))
    date_text = (F.when(k == 3, F.lit("2024-13-01")).when(k == 5, F.lit(""))
                  .otherwise(F.date_format("d", "yyyy-MM-dd")))
    desc_text = F.coalesce(F.col("descr"), F.lit(""))
    desc_text = F.when(k == 6, F.concat(F.lit('"'), desc_text, F.lit(',\n""ref"" 6"'))).otherwise(desc_text)
    body = bank_src.select(
        F.concat(F.col("acct"), F.lit(".csv")).alias("source_file"),
        # line numbers: order keys are unique, so they order a file's lines
        (F.col("o_orderkey") + 1).cast("bigint").alias("line_no"),
        F.when(F.col("o_custkey") % 4 == 1, F.concat_ws(",", desc_text, date_text, amount_text))
         .otherwise(F.concat_ws(",", date_text, desc_text, amount_text)).alias("text"))
    return hdr.unionByName(body)

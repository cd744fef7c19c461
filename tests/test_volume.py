"""What moves through the ledger's shuffles and bronze files, on rows of the tests' own."""

import datetime as dt
import os
import tracemalloc
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import Window
from pyspark.sql import functions as F

from ledgerloom.functions.ids import packed, packed_id, unpacked
from ledgerloom.functions.text import CLEAN_DESCRIPTION_PATTERN, clean_description
from ledgerloom.operators import nearest
from ledgerloom.operators.membership import may_match
from ledgerloom.operators.tolerance_join import bucket, reached
from ledgerloom.plans import gold, ingest, rebuild, silver, sinks, transfers
from ledgerloom.plans.context import Lake
from ledgerloom.sources import fixtures
from ledgerloom.streaming import inbox
from testpaths import SMALL


def _cc(spark):
    day = dt.date(1995, 3, 4)
    rows = [(50, day, day, Decimal("1.25"), "a", dt.date(1995, 3, 1)), (50, day, day, Decimal("2.50"), "b", dt.date(1995, 3, 1)),
            (98, day, day, Decimal("3.00"), "c", dt.date(1995, 4, 1)), (22, day, day, None, "c", dt.date(1995, 4, 1)),
            (None, day, day, Decimal("4.00"), "d", dt.date(1995, 4, 1)), (7, None, None, Decimal("5.00"), "e", None)]
    return spark.createDataFrame(rows, "custkey bigint, txn_date date, posting_date date, amount decimal(18,2), raw_description string, mon date")


def test_card_statements_follow_from_slim_sums(spark):
    sums = fixtures.cc_sums(fixtures.cc_src(_cc(spark)))
    assert not {"sha", "card", "holder", "card_number_last4"} & set(sums.columns)
    got = {r.sha256: (r.holder, r.card_number_last4, r.period_start, r.n_details, r.total_balance)
           for r in fixtures.cc_statements(sums).collect()}
    src = fixtures.cc_src(_cc(spark))
    sha = {(r.custkey, r.mon): r.sha for r in src.collect()}
    march, april = dt.date(1995, 3, 1), dt.date(1995, 4, 1)
    assert got == {
        sha[50, march]: ("Customer#000000050", "V50", march, 2, Decimal("3.75")),
        sha[98, april]: (None, "V98", april, 1, Decimal("3.00")),
        sha[22, april]: ("Customer#000000022", "V22X", april, 1, None),
        # without customer or month: one statement, the largest texts of its lines
        None: ("Customer#000000007", "V7", april, 2, Decimal("9.00"))}


def test_bronze_stores_no_column_that_follows_from_others(spark, tmp_path):
    spark.createDataFrame([(1, 3, "O", 10.0, dt.datetime(1995, 1, 2))],
                          "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, o_orderdate timestamp_ntz"
                          ).write.parquet(f"{tmp_path}/orders.parquet")
    spark.createDataFrame([(3, "Customer#3", "AUTO")], "c_custkey bigint, c_name string, c_mktsegment string").write.parquet(f"{tmp_path}/customer.parquet")
    spark.createDataFrame([(1, "part")], "p_partkey bigint, p_name string").write.parquet(f"{tmp_path}/part.parquet")
    fx = fixtures.Fixtures(spark, str(tmp_path))
    assert not {"sha", "acct", "mon"} & set(fx.bank_lines.columns)
    (line,), (statement,) = fx.bank_transactions.collect(), fx.bank_statements.collect()
    assert (line.statement_sha256, line.account_number) == (statement.sha256, statement.account_number)
    assert statement.closing_balance == Decimal("10.00")


def test_packed_texts_come_back(spark):
    texts = ["", "a0", "A0", "a", "0f" * 32, "a0\n", "a0é", None, "zz", "\x01a0"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    rows = df.select("t", packed(F.col("t")).alias("p"), unpacked(packed(F.col("t"))).alias("u")).collect()
    assert [r.u for r in rows] == texts
    assert len({bytes(r.p) for r in rows if r.p is not None}) == len(texts) - 1
    assert len(rows[4].p) == 33


def test_only_rows_that_may_match_take_the_join(spark):
    rows = spark.range(5000).select(F.md5(F.col("id").cast("string")).alias("k")).unionByName(spark.createDataFrame([(None,)], "k string"))
    keys = spark.range(0, 5000, 250).select(F.md5(F.col("id").cast("string")).alias("k2")).unionByName(spark.createDataFrame([(None,)], "k2 string"))
    marked = may_match(rows, F.col("k"), keys)
    assert marked.count() == 5001
    held = {r.k2 for r in keys.collect()} - {None}
    may = {r.k for r in marked.filter("_may").collect()}
    assert held <= may and len(may) <= len(held) + 5
    assert may_match(rows, F.col("k"), keys.limit(0)).filter("_may").count() == 0


def test_overrides_and_descriptions_of_the_fact(spark):
    """An override that comes twice gives its line twice; lines without account, date or override stay."""
    day = dt.date(1995, 1, 2)
    header = spark.createDataFrame([("aa", "A1", "h")], "sha256 string, account_number string, holder string")
    bank = spark.createDataFrame([("aa", "A1", day, Decimal("1.00"), "x", None), ("aa", "A1", None, Decimal("2.00"), None, None),
                                  ("not hex", None, day, None, "x", None)],
                                 "statement_sha256 string, account_number string, txn_date date, amount decimal(18,2), raw_description string, running_balance decimal(18,2)")
    cards = spark.createDataFrame([], "statement_sha256 string, card_number string, txn_date date, posting_date date, amount decimal(18,2), raw_description string")
    lines = silver.txn_lines(silver.txn_bank_numbered(bank, header),
                             silver.txn_cc_numbered(cards, spark.createDataFrame([], "sha256 string, holder string")))
    ids = {r.statement_sha256 + str(r.amount): r.stable_id for r in silver.txn_unified(lines).collect()}
    assert set(ids) == {"aa1.00", "aa2.00", "not hexNone"}
    over = spark.createDataFrame([(ids["aa1.00"], "travel"), (ids["aa1.00"], "transfer"), (None, "none")], "stable_id string, category_id string")
    accounts = spark.createDataFrame([("A1", "one", "bank", -1)], "account_id string, friendly_name string, account_kind string, inversion_factor int")
    got = silver.with_accounts_and_overrides(lines, accounts, over)
    assert sorted((str(r.amount), str(r.o_category), str(r.friendly_name)) for r in got.collect()) == [
        ("1.00", "transfer", "one"), ("1.00", "travel", "one"), ("2.00", "None", "one"), ("None", "None", "None")]


def test_rule_texts_come_from_bronze_not_from_the_numbered_lines(spark, tmp_path):
    """The numbering of each side is planned once per path to the result, not once more for the rules' texts."""
    lake = Lake(spark, SMALL)
    plan = lake._staged(lake.txn_lines)._jdf.queryExecution().optimizedPlan().toString()
    windows = plan.count("Window [")
    assert windows == lake.txn_lines._jdf.queryExecution().optimizedPlan().toString().count("Window [")


def test_only_repeated_files_are_shuffled_for_their_first_copy(spark):
    rows = [("a", 1, "s1", 1), ("a", 0, "s2", 2), ("b", 0, "s3", 3), ("c", 0, "s5", 4), ("c", 0, "s4", 5), ("c", 0, "s4", 6), ("d", 2, None, 7)]
    docs = spark.createDataFrame(rows, "sha256 string, source_order int, source_id string, row bigint")
    assert sorted(r.row for r in rebuild.first_received(docs).collect()) == [2, 3, 5, 7]
    many = spark.range(3000).select(F.md5(F.col("id").cast("string")).alias("sha256"), F.lit(0).alias("source_order"),
                                    F.lit("s").alias("source_id"), F.col("id").alias("row"))
    assert rebuild.first_received(many.unionByName(docs.select(*many.columns))).count() == 3004


def test_written_fact_holds_no_column_that_follows_from_others(spark):
    lake = Lake(spark, SMALL)
    fact = lake.fact_table
    stored = set(spark.read.parquet(f"{lake._run_folder}/fact_transactions").columns)
    assert not {"transaction_id", "stable_id", "clean_description", "day_of_week_name", "category_id"} & stored
    assert fact.columns == lake.fact_transactions.columns


def test_rules_and_merchants_are_written_before_the_lines_meet_them(spark):
    """Their size is known then, so the lines are not shuffled for a small one."""
    lake = Lake(spark, SMALL)
    lake.fact_transactions
    assert {"fact_merchants", "description_rules"} <= set(os.listdir(lake._run_folder))


def test_numbered_hashes_are_unpacked_behind_the_shuffle(spark):
    day = dt.date(1995, 1, 2)
    header = spark.createDataFrame([("aa", "A1", "h")], "sha256 string, account_number string, holder string")
    bank = spark.createDataFrame([("aa", "A1", day, Decimal("1.00"), "x", None)] * 2,
                                 "statement_sha256 string, account_number string, txn_date date, amount decimal(18,2), raw_description string, running_balance decimal(18,2)")
    numbered = silver.txn_bank_numbered(bank, header)
    assert sorted((r.statement_sha256, r.dup_seq) for r in numbered.collect()) == [("aa", 1), ("aa", 2)]
    assert "RepartitionByExpression" in numbered._jdf.queryExecution().optimizedPlan().toString()


def test_reached_buckets_meet_once_and_seldom_repeat(spark):
    values = spark.range(-60, 60)
    a = values.select(F.col("id").alias("a"), reached(F.col("id"), 20, 5).alias("b"))
    b = values.select(F.col("id").alias("c"), bucket(F.col("id"), 20).alias("d"))
    pairs = a.join(b, F.col("b") == F.col("d")).filter(F.abs(F.col("a") - F.col("c")) <= 5).select("a", "c")
    assert sorted(map(tuple, pairs.collect())) == [(x, y) for x in range(-60, 60) for y in range(-60, 60) if abs(x - y) <= 5]
    assert a.count() == 120 * 1.5


def test_only_rows_that_may_be_duplicates_are_shuffled_whole(spark):
    day, amount = dt.date(1995, 1, 2), Decimal("1.00")
    rows = [(day, amount, "A", "x", f"acct {i}", "raw") for i in range(2)] + [
        (day, amount, "B", "x", "b", "raw"), (day, None, "A", "x", "n", "raw"), (day, None, "A", "x", "n", "raw")]
    fact = spark.createDataFrame(rows, "txn_date date, amount decimal(18,2), account_id string, clean_description string, account_name string, raw_description string")
    alerts = gold.duplicate_alerts(fact)
    assert sorted((r.account_name, r.alert_message) for r in alerts.collect()) == [
        (f"acct {i}", "Found 2 identical transactions") for i in range(2)]
    assert "bitmap" in alerts._jdf.queryExecution().optimizedPlan().toString()


def test_later_copies_are_told_without_payload(spark, tmp_path):
    rows = [("a", 1, "s1", 1, "x" * 50), ("a", 0, "s2", 2, "y"), ("b", 0, "s3", 3, "z"), ("c", 0, "s4", 5, "v"), ("c", 0, "s4", 6, "w")]
    docs = spark.createDataFrame(rows, "sha256 string, source_order int, source_id string, row bigint, body string")
    docs.write.parquet(f"{tmp_path}/docs")
    docs = spark.read.parquet(f"{tmp_path}/docs")
    later = rebuild.later_copies(docs)
    assert later.columns == ["sha256", "row"] and sorted(r.row for r in later.collect()) == [1, 6]
    assert "body" not in later._jdf.queryExecution().executedPlan().toString()
    assert sorted(r.body for r in rebuild.without_rows(docs, later).collect()) == ["v", "y", "z"]


def _line(day, amount, text, sha="aa", account="A1", balance=None):
    return (sha, account, day, Decimal(amount), text, balance)


_BANK_LINES = "statement_sha256 string, account_number string, txn_date date, amount decimal(18,2), raw_description string, running_balance decimal(18,2)"


def test_only_lines_that_come_again_are_shuffled_for_their_number(spark):
    """Against row_number: copies in one statement and in two, copies of a header, several holders, null keys."""
    day = dt.date(1995, 1, 2)
    rows = ([_line(day, "1.00", "x")] * 3 + [_line(day, "1.00", "x", sha="bb")] * 2 + [_line(day, "2.00", "y", sha="cc")]
            + [_line(None, "3.00", None, sha=None)] * 2 + [_line(day, "4.00", "z", sha="dd"), _line(day, "5.00", "z", account=None)])
    bank = spark.createDataFrame(rows, _BANK_LINES)
    header = spark.createDataFrame([("aa", "A1", "h"), ("bb", "A1", "h"), ("cc", "A1", "h"), ("cc", "A1", "h"), ("cc", "A1", None),
                                    ("dd", "A2", "h"), (None, "A1", "h")], "sha256 string, account_number string, holder string")
    keys = ["holder", "account_number", "txn_date", "amount", "raw_description", "running_balance"]
    joined = bank.join(header.withColumnRenamed("account_number", "h_account"),
                       (F.col("statement_sha256") == F.col("sha256")) & (F.col("account_number") == F.col("h_account")), "left")
    place = Window.partitionBy(*keys).orderBy(F.col("statement_sha256").asc_nulls_last())
    wanted = joined.select(*keys, "statement_sha256", F.row_number().over(place).cast("bigint").alias("dup_seq"))
    numbered = silver.txn_bank_numbered(bank, header)
    assert numbered.columns == wanted.columns and numbered.schema["dup_seq"].dataType == wanted.schema["dup_seq"].dataType
    assert sorted(map(str, numbered.collect())) == sorted(map(str, wanted.collect()))
    assert "bitmap" in numbered._jdf.queryExecution().optimizedPlan().toString()


def test_descriptions_are_cleaned_once_each(spark):
    """The distinct descriptions stay below the cleaning; only then are the clean texts made distinct."""
    texts = spark.createDataFrame([("A-b",), ("A b",), (None,)], "raw_description string").distinct()
    rules = spark.createDataFrame([("r", "food", "a b", 1)], "rule_id string, category_id string, pattern string, priority int")
    found = silver.description_rules(texts, spark.createDataFrame([], "pattern string"), rules)
    assert [tuple(r) for r in found.select("text", "first_category").collect()] == [("a b", "food")]
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    cleaned = plan[plan.index("regexp_replace"):]
    assert "Aggregate [raw_description" in cleaned


def test_transfer_ids_travel_packed_and_sort_as_texts(spark):
    ids = [f"{i:032x}" for i in (5, 2 ** 127, 1, 77)]
    df = spark.createDataFrame([(i,) for i in [*ids, "x10", "x9", "0f"]], "t string").select("t", packed_id(F.col("t")).alias("p"))
    assert all(r.t == r.u for r in df.select("t", unpacked(F.col("p")).alias("u")).collect())
    got = {r.t: bytes(r.p) for r in df.collect()}
    assert sorted(ids, key=got.get) == sorted(ids) and len(got[ids[0]]) == 17
    assert sorted(["x10", "x9", "0f"], key=got.get) == ["0f", "x10", "x9"]
    day = dt.date(1995, 1, 2)
    fact = spark.createDataFrame([(ids[0], "A", day, Decimal("-1.00")), (ids[1], "B", day, Decimal("1.00")), (ids[2], "B", day, Decimal("1.00"))],
                                 "transaction_id string, account_id string, txn_date date, amount decimal(18,2)")
    assert dict(transfers._cells(fact).dtypes)["id"] == "binary"
    assert [tuple(r) for r in transfers.mutual_best(fact).collect()] == [(ids[0], ids[2], Decimal("-1.00"))]


def test_exports_are_dropped_in_bundles(spark, tmp_path):
    """Few files however many exports; quoted line breaks, odd names, several splits and empty bodies come back."""
    rows = []
    for i in range(300):
        name = f"A {i}\t#é.csv" if i % 50 == 7 else f"A{i}.csv"
        rows += [(name, 0, "Date,Description,Amount"), (name, 1, f'2024-01-02,"a,\nb\r\nc {i}",{i}.50'), (name, 3, "bad,row,1"), (name, 2, f"20240103,d,{i}")]
        if i % 3 == 0:  # lines of one number
            rows += [(name, 1, f'2024-01-04,"e\n{i}",{i}.25')] * 2
    lines = spark.createDataFrame(rows, "source_file string, line_no bigint, text string")
    inbox.drop_exports(lines, f"{tmp_path}/inbox")
    assert len([f for _, _, fs in os.walk(f"{tmp_path}/inbox") for f in fs if f.startswith("part-")]) <= 32
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "400")
    try:
        inbox.run_inbox_stream(spark, f"{tmp_path}/inbox", f"{tmp_path}/bronze", f"{tmp_path}/bad", f"{tmp_path}/ckpt", f"{tmp_path}/archive",
                               "2024-02-01 00:00:00", bundled=True)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    got = spark.read.parquet(f"{tmp_path}/bronze").drop("batch").collect()
    wanted = []
    for i in range(300):
        name = f"A {i}\t#é.csv" if i % 50 == 7 else f"A{i}.csv"
        wanted += [(name, dt.date(2024, 1, 2), f"a,\nb\nc {i}", Decimal(f"{i}.50")), (name, dt.date(2024, 1, 3), "d", Decimal(f"{i}.00"))]
        wanted += [(name, dt.date(2024, 1, 4), f"e\n{i}", Decimal(f"{i}.25"))] * (2 if i % 3 == 0 else 0)
    assert sorted((r.source_file, r.row_date, r.description, r.amount) for r in got) == sorted(wanted)
    assert spark.read.parquet(f"{tmp_path}/bad").count() == 300


def test_nearest_task_holds_one_copy_of_its_blocks():
    rng = np.random.default_rng(3)
    n, dim = 4000, 64
    vectors = rng.normal(size=(n, dim))
    block = pa.table({"id": [str(i) for i in range(n)], "vec": pa.ListArray.from_arrays(
        pa.array(np.arange(0, n * dim + 1, dim), pa.int32()), pa.array(vectors.ravel()))})
    pivots = vectors[:4] / np.linalg.norm(vectors[:4], axis=1)[:, None]
    angles = np.arccos(np.clip(vectors @ pivots.T / np.linalg.norm(vectors, axis=1)[:, None], -1, 1))
    cell = angles.argmin(axis=1)
    merchants = block.append_column("cell", pa.array(cell, pa.int32())).append_column("angle", pa.array(angles[np.arange(n), cell]))
    merchants = pa.Table.from_batches(merchants.to_batches(max_chunksize=700))
    queries = block.slice(0, 50)
    task = nearest._cell_task(pivots, cells=1 << 10)
    tracemalloc.start()
    found = task(queries, merchants)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 1.8 * vectors.nbytes
    assert found["other_id"].to_pylist() == queries["id"].to_pylist()  # each is its own nearest


def _ledger_rows(spark, rows):
    return spark.createDataFrame(rows, "transaction_id string, account_id string, txn_date date, amount decimal(18,2), clean_description string")


def test_only_rows_near_the_other_side_become_cells(spark):
    """Of 3,000 debits far from any credit none is shuffled with its id; those near one are all kept."""
    day = dt.date(1995, 1, 2)
    far = [(f"{i:032x}", "A", day, Decimal(-1000 * (i + 10)), "x") for i in range(3000)]
    near = [("d1", "A", day, Decimal("-5.05"), "x"), ("d2", "A", dt.date(1995, 1, 9), Decimal("-5.00"), "x"), ("d3", "C", day, Decimal("-600.00"), "x"),
            ("d4", None, day, Decimal("-5.00"), "x"), ("d5", "A", None, Decimal("-5.00"), "x"), ("d6", "A", day, Decimal("-5.06"), "x"),
            ("c1", "A", day, Decimal("5.00"), "x"), ("c2", "B", dt.date(1995, 1, 12), Decimal("600.05"), "x")]
    fact = _ledger_rows(spark, far + near)
    held = {}
    got = transfers.mutual_best(fact, lambda name, df: held.setdefault(name, df)).collect()
    ids = {r.u for r in held["transfer_debits"].select(unpacked(F.col("id")).alias("u")).collect()}
    assert {"d1", "d2", "d3"} <= ids and len(ids) < 20
    spots = {tuple(r) for r in held["transfer_spots"].collect()}
    assert spots == {(True, 505, 9132), (True, 500, 9139), (True, 60000, 9132), (False, 500, 9132), (False, 60005, 9142)}
    assert {(r.debit_txn_id, r.credit_txn_id) for r in got} == {("d1", "c1"), ("d3", "c2")}
    assert sorted(map(tuple, got)) == sorted(map(tuple, transfers.transfer_matches(transfers.transfer_candidates(fact)).collect()))


def test_ranks_are_cut_to_two_accounts_where_they_met(spark):
    rnd = __import__("random").Random(5)
    rows = [(c, 0, c % 2, b, (rnd.randint(0, 3), rnd.randint(0, 2), bytes([i, c]), rnd.choice(["A", "A", "A", "B", "C"])))
            for c in range(8) for i, b in enumerate([0] * 40 + [1] * 20)] + [(9, 0, 0, 0, (1, 1, b"z", "A"))]
    near = spark.createDataFrame(rows, "q_cents bigint, q_day int, _ab bigint, _db bigint, rank struct<day_gap:bigint,amount_gap:bigint,id:binary,acct:string>")
    wanted = {}
    for c in {r[0] for r in rows}:
        ranks = sorted(r[4] for r in rows if r[0] == c)
        wanted[c] = (ranks[0], next((r for r in ranks if r[3] != ranks[0][3]), None))
    two = transfers._two_best(near)
    as_tuple = lambda r: r if r is None else (r.day_gap, r.amount_gap, bytes(r.id), r.acct)
    assert {r.s_cents: (as_tuple(r.one), as_tuple(r.other)) for r in two.collect()} == wanted
    # Behind the buckets a spot has two ranks at most.
    assert two._jdf.queryExecution().optimizedPlan().toString().count("collect_list") == 2


def test_debits_are_not_shuffled_for_few_outbound_texts(spark, tmp_path):
    day = dt.date(1995, 1, 2)
    rows = [(f"{i:032x}", "A", day, Decimal(-i - 1), "wire abroad" if i % 10 == 0 else f"shop {i}") for i in range(200)] + [("n", "A", day, None, "wire abroad")]
    fact = sinks.materialize(_ledger_rows(spark, rows), f"{tmp_path}/fact")
    rules = spark.createDataFrame([("w_re", "outbound"), ("shop", "inbound"), (None, "outbound")], "pattern string, direction string")
    matches = spark.createDataFrame([(f"{0:032x}", "c"), (None, "c")], "debit_txn_id string, credit_txn_id string")
    got = transfers.one_way_transfers(fact, rules, matches, lambda name, df: sinks.materialize(df, f"{tmp_path}/{name}"))
    assert sorted(r.debit_txn_id for r in got.collect()) == [f"{i:032x}" for i in range(10, 200, 10)]
    assert "hashpartitioning(clean_description" not in got._jdf.queryExecution().executedPlan().toString()


def test_semantic_rows_are_shuffled_only_where_they_may_be_marked(spark, monkeypatch):
    """Transfers and overrides that come twice, null ids, ids that are no hash and merchants of one name."""
    n = 3000
    fact = spark.range(n).select(
        F.when(F.col("id") < 2, F.lit(None)).when(F.col("id") == 2, F.lit("ID-2")).otherwise(F.md5(F.col("id").cast("string"))).alias("transaction_id"),
        F.when(F.col("id") == 1, F.lit(None)).otherwise(F.md5((F.col("id") + 5).cast("string"))).alias("stable_id"),
        F.lit("1995-01-02").cast("date").alias("txn_date"), F.lit("Monday").alias("day_of_week_name"), F.lit(False).alias("is_weekend"),
        F.col("id").cast("decimal(18,2)").alias("amount"), F.lit("r").alias("raw_description"),
        F.when(F.col("id") % 7 != 0, F.concat(F.lit("m"), F.col("id") % 7)).alias("clean_description"),
        F.lit("a").alias("account_name"), F.lit("bank").alias("account_kind"), F.lit("bank").alias("source_system"))
    merchants = spark.createDataFrame([("m1", "x"), ("m1", "y"), ("m2", None), (None, "x"), ("m3", "none")], "canonical_name string, category_id string")
    categories = spark.createDataFrame([("x", "X", None), ("y", "Y", "x")], "category_id string, category_name string, parent_category_id string")
    ids = fact.select("transaction_id", "stable_id")
    transfers_ = ids.filter(F.col("amount") % 300 == 2).select("transaction_id")
    transfers_ = transfers_.unionByName(transfers_).unionByName(spark.createDataFrame([(None,), ("other",)], "transaction_id string"))
    over = ids.filter(F.col("amount") % 500 == 3).select("stable_id")
    over = over.withColumn("category_id", F.lit("y")).unionByName(over.withColumn("category_id", F.lit("gone"))).unionByName(
        spark.createDataFrame([(None, "x")], "stable_id string, category_id string"))
    marks = []
    real = gold.may_match
    monkeypatch.setattr(gold, "may_match", lambda *a: marks.append(real(*a)) or marks[-1])
    names = []
    got = gold.semantic_transactions(fact, merchants, categories, transfers_, over, lambda name, df: names.append(name) or df)
    # Of 3,000 rows the few that may be marked meet the transfers and the overrides.
    assert 16 <= marks[-1].filter("_may_f or _may_o").count() < 40
    assert len(names) == 3

    fact.createOrReplaceTempView("f_sem"), merchants.createOrReplaceTempView("m_sem"), categories.createOrReplaceTempView("c_sem")
    transfers_.createOrReplaceTempView("t_sem"), over.createOrReplaceTempView("o_sem")
    plain = spark.sql("""
        WITH c AS (SELECT a.category_id, a.category_name n, b.category_name p FROM c_sem a LEFT JOIN c_sem b ON a.parent_category_id = b.category_id)
        SELECT f.transaction_id, f.amount, coalesce(m.canonical_name, f.clean_description) merchant_name,
               coalesce(oc.n, mc.n, 'Uncategorised') category_name, coalesce(oc.p, mc.p, 'Uncategorised') parent_category_name,
               t.transaction_id IS NOT NULL is_transfer
        FROM f_sem f LEFT JOIN m_sem m ON f.clean_description = m.canonical_name LEFT JOIN c mc ON m.category_id = mc.category_id
        LEFT JOIN (SELECT DISTINCT transaction_id FROM t_sem) t ON f.transaction_id = t.transaction_id
        LEFT JOIN o_sem o ON f.stable_id = o.stable_id LEFT JOIN c oc ON o.category_id = oc.category_id""")
    rows = [tuple(r) for r in got.select(*plain.columns).collect()]
    assert sorted(map(str, rows)) == sorted(str(tuple(r)) for r in plain.collect())
    assert sum(r[-1] for r in rows) and len(rows) > n


def _optimized(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_a_long_key_is_worked_out_once_a_row(spark):
    rows = spark.range(100).select(F.col("id").cast("string").alias("k"))
    marked = may_match(rows, F.md5("k"), rows.limit(3).select(F.md5("k").alias("m")).distinct())
    sides = _optimized(marked)
    assert sides.count("md5(") == 2  # one for the rows, one for the keys
    assert {r.k for r in marked.filter("_may").collect()} >= {r.k for r in rows.limit(3).collect()}


def test_clean_text_equals_its_pattern(spark):
    texts = ["".join(map(chr, range(128))), "Ünïcode-Ärger #12", "a\U0001f600B", "", None, "  Two  ", "İI", "x\u0000Y", "Ⅷ-٣"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    rows = df.select(clean_description(F.col("t")).alias("a"), F.lower(F.regexp_replace("t", CLEAN_DESCRIPTION_PATTERN, " ")).alias("b")).collect()
    assert [r.a for r in rows] == [r.b for r in rows]


def test_lines_meet_their_headers_once_for_the_fact(spark):
    """Splitting the numbered lines by their overrides would plan, and run, all the numbering once more."""
    lake = Lake(spark, SMALL)
    assert _optimized(lake.fact_lines).count("Window [") == _optimized(lake.txn_lines).count("Window [")


def test_overrides_of_numbered_lines(spark):
    """Copies, copies of a header, overrides that come twice or name no category, lines without hash: as by a plain join."""
    day = dt.date(1995, 1, 2)
    bank = spark.createDataFrame([_line(day, "1.00", "x")] * 3 + [_line(day, "2.00", "y", sha="cc"), _line(day, "6.00", "y"), _line(day, "3.00", "z", sha=None),
                                                                  _line(None, "4.00", None, sha="no hash"), _line(day, "5.00", "q", account=None)], _BANK_LINES)
    header = spark.createDataFrame([("aa", "A1", "h"), ("cc", "A1", "h"), ("cc", "A1", "h")], "sha256 string, account_number string, holder string")
    ids = bank.select("amount", F.md5(F.concat_ws("|", "statement_sha256", "account_number", F.col("txn_date").cast("string"), F.col("amount").cast("string"))).alias("stable_id"))
    named = {"1.00": "a", "2.00": "b", "3.00": None, "4.00": "d"}
    rows = [(r.stable_id, named[str(r.amount)]) for r in ids.distinct().collect() if str(r.amount) in named]
    over = spark.createDataFrame([*rows, (rows[0][0], "again"), (None, "none")], "stable_id string, category_id string")
    numbered = silver.txn_bank_numbered(bank, header)
    wanted = numbered.withColumn("stable_id", F.md5(F.concat_ws("|", "statement_sha256", "account_number", F.col("txn_date").cast("string"), F.col("amount").cast("string")))).join(
        over.withColumn("hit", F.lit(True)), "stable_id", "left").select(*numbered.columns, F.col("category_id").alias("o_category"), F.coalesce("hit", F.lit(False)).alias("overridden"))
    got = silver.txn_bank_numbered(bank, header, over)
    assert got.columns == wanted.columns
    assert sorted(map(str, got.collect())) == sorted(map(str, wanted.collect()))


def test_transfer_words_are_looked_for_once_a_text(spark):
    rules = spark.createDataFrame([("r", "food", "a b", 1)], "rule_id string, category_id string, pattern string, priority int")
    lines = spark.createDataFrame([("A-b",), ("my transfer",), ("a b tf1",), ("c",), (None,)], "raw_description string")
    found = silver.description_rules(lines, spark.createDataFrame([], "pattern string"), rules)
    staged = silver.with_categorisation_inputs(lines, found.localCheckpoint())
    assert "RLIKE" not in _optimized(staged)
    got = {r.raw_description: (r.detected_transfer, r.rule_category) for r in staged.collect()}
    assert got == {"A-b": (False, "food"), "my transfer": (True, None), "a b tf1": (True, None), "c": (False, None), None: (None, None)}


def test_one_way_transfers_are_found_once_for_both_sides(spark):
    fact = _ledger_rows(spark, [("d", "A", dt.date(1995, 1, 2), Decimal("-1.00"), "wire")] * 2)
    rules = spark.createDataFrame([("wire", "outbound")], "pattern string, direction string")
    matches = spark.createDataFrame([("m", "c", Decimal("-1.00"))], "debit_txn_id string, credit_txn_id string, amount decimal(18,2)")
    both = transfers.fact_transfers(matches, transfers.one_way_transfers(fact, rules, matches))
    assert _optimized(both).count("LeftAnti") == 1
    assert sorted(map(str, (tuple(r) for r in both.collect()))) == ["('c', 'transfer', 'm')", "('d', 'transfer', None)", "('m', 'transfer', 'c')"]


def test_ids_are_worked_out_for_rows_at_live_spots_only(spark):
    """The id is asked for above the filter by spots, and the matches are those of the plain fact."""
    lake = Lake(spark, SMALL)
    fact, transaction_id = lake._fact_measures()
    assert "transaction_id" not in fact.columns
    plain = transfers.mutual_best(lake.fact_table)
    assert sorted(map(str, lake.transfer_matches.collect())) == sorted(map(str, plain.collect()))


_HEADER = "holder string, bank string, product string, {} string, period_start date, period_end date"
_DOCUMENT = (f"sha256 string, source_type string, source_id string, source_order int, kind string, "
             f"accounts array<struct<header:struct<{_HEADER.format('account_number')}>,details:array<struct<amount:int>>>>, "
             f"card struct<header:struct<{_HEADER.format('card_number_last4')}>,details:array<struct<amount:int>>>, issues array<string>")


def _documents(spark):
    day = dt.date(1995, 1, 31)
    head = lambda name: ("h", name, "p", "A1234", day, day)
    bank = lambda name: [(head(name), [(1,), (2,)])]
    rows = [("aa", "local", "s1", 0, "bank", bank("one"), None, []), ("aa", "local", "s1#2", 1, "bank", bank("one"), None, []),
            ("bb", "local", "s2", 0, "cc", None, (head("two"), [(1,), (2,), (3,)]), ["odd"]), ("cc", "local", "s3", 0, "multi", [], None, []),
            ("dd", "local", "s4", 0, "cc", None, (head("known"), []), []), (None, "local", "s5", 0, "cc", None, (head("none"), []), []),
            (None, "local", "s6", 0, "cc", None, (head("none"), []), []), ("not hex", "local", "s7", 0, "cc", None, (head("odd"), [(4,)]), []),
            ("ee", "local", "s8", 0, None, None, None, []), ("ff", "local", None, 0, "cc", None, (head("no id"), [(4,)]), [])]
    return spark.createDataFrame(rows, _DOCUMENT), spark.createDataFrame([("dd",), (None,)], "sha256 string")


def test_received_documents_are_shuffled_once_for_what_is_known_of_their_hash(spark):
    documents, prior = _documents(spark)
    first = ingest.first_copies(documents, prior)
    assert {(r.sha256, r.source_id) for r in first.collect()} == {("aa", "s1"), ("bb", "s2"), ("cc", "s3"), (None, "s5"), ("not hex", "s7"), ("ff", None)}
    result = ingest.statement_ingest_result(documents, first, prior)
    assert _optimized(result).count("Join LeftOuter") == 1
    got = {(r.source_id, r.sha256): (r.was_finance_doc, r.was_new_row, r.bank, r.last4, r.validation_issues) for r in result.collect()}
    assert got == {("s1", "aa"): (True, True, "one", "1234", []), ("s1#2", "aa"): (True, False, None, None, []),
                   ("s2", "bb"): (True, True, "two", "1234", ["odd"]), ("s3", "cc"): (False, False, None, None, ["multi_account_no_accounts"]),
                   ("s4", "dd"): (True, False, None, None, []), ("s5", None): (True, False, None, None, []), ("s6", None): (True, False, None, None, []),
                   ("s7", "not hex"): (True, True, "odd", "1234", []), ("s8", None): (False, False, None, None, []), (None, "ff"): (True, False, None, None, [])}


def test_card_headers_are_picked_without_their_details(spark):
    documents, prior = _documents(spark)
    slim = ingest.first_copies(ingest.card_headers(documents), prior)
    assert ingest.card_headers(documents).count() == documents.count()  # copies are told by the hash alone, whatever the kind
    assert slim.schema["card"].dataType.names == ["header", "n_details"]
    plain, counted = (ingest.bronze_cc_statements(f).select("sha256", "source_id", "bank", "n_details", "validation_issues")
                      for f in (ingest.first_copies(documents, prior), slim))
    assert sorted(map(str, counted.collect())) == sorted(map(str, plain.collect()))
    assert {(r.sha256, r.n_details) for r in counted.collect()} == {("bb", 3), (None, 0), ("not hex", 1), ("ff", 1)}


def test_details_are_packed_once_a_row(spark):
    """A filter of hashes that are not null stays above the packing."""
    lake = Lake(spark, SMALL)
    assert not [line for line in _optimized(lake.statement_documents).split("\n") if "Filter" in line and "unhex" in line]


def test_repeated_documents_are_looked_for_once_for_all_tables(spark):
    docs = spark.createDataFrame([("a", 1, "x"), ("a", 2, "y"), ("b", 3, "z"), (None, 4, "n")], "sha256 string, row bigint, body string")
    dropped = spark.createDataFrame([("a", 2), (None, 4)], "sha256 string, row bigint")
    written = {}
    good = rebuild.without_rows(docs, dropped, lambda name, df: written.setdefault(name, df))
    assert list(written) == ["asked"] and "body" in written["asked"].columns
    assert sorted(r.body for r in good.collect()) == ["x", "z"]

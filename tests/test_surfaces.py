"""Read-only SQL gate, JSON surface, file landing, seed reading."""

import json
import os
import tempfile

import pytest

from ledgerloom.plans.read_only import ReadOnlyViolation, check_read_only, read_only_pages, read_only_sql, read_only_sql_json
from ledgerloom.sources.statements import land_files


@pytest.mark.parametrize("sql", [
    "INSERT INTO t SELECT 1", "WITH x AS (SELECT 1) INSERT INTO t SELECT * FROM x", "DROP TABLE t",
    "select 1; drop table t", "CREATE TABLE t AS SELECT 1", "", "SET spark.x=1"])
def test_gate_refuses(spark, sql):
    with pytest.raises(ReadOnlyViolation):
        check_read_only(spark, sql)


@pytest.mark.parametrize("sql", [
    "SELECT 1", "  with x as (select 'insert' as w) select * from x ", "EXPLAIN SELECT 1", "SHOW TABLES",
    "DESCRIBE t", "SELECT 'drop table' AS s -- insert\n"])
def test_gate_accepts(spark, sql):
    assert check_read_only(spark, sql)


def test_json_surface(spark):
    out = json.loads(read_only_sql_json(spark, "SELECT DATE'2001-02-03' AS d, CAST(1.50 AS DECIMAL(18,2)) AS a"))
    assert out == [{"d": "2001-02-03", "a": 1.5}]
    assert "error" in json.loads(read_only_sql_json(spark, "DELETE FROM t"))
    assert "error" in json.loads(read_only_sql_json(spark, "SELECT * FROM no_such_table"))


def test_gate_reads_the_plan(spark):
    spark.sql("CREATE OR REPLACE TEMPORARY VIEW gate_plain AS SELECT 1 AS a")
    spark.sql("CREATE OR REPLACE TEMPORARY VIEW gate_hidden AS SELECT reflect('java.lang.Math', 'abs', -1) AS a")
    for sql in ("SELECT 1 AS add", "SELECT a AS insert, a AS `drop` FROM gate_plain", "SELECT 'x; DROP TABLE t' AS s;", "SELECT 1 AS reflect",
                "WITH call AS (SELECT 1 AS use) SELECT * FROM call", "SELECT a FROM gate_plain /* ; insert */ WHERE a = 1", "DESCRIBE gate_plain",
                "SHOW COLUMNS IN gate_plain", "EXPLAIN SELECT a AS set FROM gate_plain", "VALUES (1), (2)", "TABLE gate_plain", "FROM gate_plain |> SELECT a",
                "SELECT a, count(*) FROM gate_plain GROUP BY a HAVING a > 0 ORDER BY a LIMIT 3 OFFSET 0", "SELECT DISTINCT a FROM gate_plain",
                "(SELECT 1) UNION (SELECT 2) EXCEPT SELECT 3 INTERSECT SELECT 4 ORDER BY 1", "SELECT * FROM IDENTIFIER('gate_plain')",
                "SELECT sum(a) OVER w FROM gate_plain WINDOW w AS (ORDER BY a)", "SELECT * FROM gate_plain PIVOT (max(a) FOR a IN (1, 2))",
                "SELECT /*+ REPARTITION(2) */ a FROM gate_plain", "SELECT a FROM gate_plain DISTRIBUTE BY a SORT BY a", "WITH c AS (SELECT 1 AS a) TABLE c",
                "SELECT * FROM gate_plain LATERAL VIEW explode(array(1, 2)) x AS y", "WITH c AS (WITH d AS (SELECT 1 AS a) SELECT * FROM d) SELECT * FROM c"):
        assert read_only_sql(spark, sql).columns
    for sql in ("SELECT `REFLECT`('java.lang.Math', 'abs', -1)", "SELECT Java_Method('java.lang.Math', 'abs', -1)",
                "SELECT (SELECT try_reflect('java.lang.Math', 'abs', -1))", "WITH c AS (SELECT reflect('java.lang.Math', 'abs', -1) AS a) SELECT a FROM c",
                "SELECT a FROM gate_plain WHERE EXISTS (SELECT 1 WHERE a = system.builtin.reflect('java.lang.Math', 'abs', -1))",
                "SELECT * FROM gate_hidden", "EXPLAIN INSERT INTO t SELECT 1", "EXPLAIN SELECT reflect('java.lang.Math', 'abs', -1)",
                "EXECUTE IMMEDIATE 'SELECT 1'", "EXPLAIN EXECUTE IMMEDIATE 'SELECT 1'", "FROM gate_plain INSERT INTO t SELECT a",
                "WITH c AS (SELECT 1 AS a) FROM c INSERT OVERWRITE DIRECTORY '/nowhere' USING json SELECT a", "USE default", "CACHE TABLE gate_plain",
                "BEGIN SELECT 1; END", "CALL p()", "INSERT INTO IDENTIFIER('t') SELECT 1", "WITH c AS (SELECT 1) INSERT INTO IDENTIFIER('t') SELECT * FROM c",
                "FROM gate_plain INSERT INTO IDENTIFIER('t') SELECT a INSERT INTO IDENTIFIER('u') SELECT a", "CREATE VIEW IDENTIFIER('z') AS SELECT 1",
                "SET VAR x = 1", "DECLARE x INT", "ANALYZE TABLE t COMPUTE STATISTICS", "REFRESH TABLE t", "ADD JAR 'x'", "  ", ";", "SELEC 1"):
        with pytest.raises(ReadOnlyViolation):
            read_only_sql(spark, sql)


def test_reply_in_pages(spark):
    pages = [json.loads(p) for p in read_only_pages(spark, "SELECT id AS n, id % 2 AS n FROM range(25)", page_rows=10)]
    assert [len(p) for p in pages] == [10, 10, 5]
    assert list(read_only_pages(spark, "SELECT 1 AS a WHERE false")) == []
    assert read_only_sql_json(spark, "SELECT 1 AS a WHERE false") == "[]"
    whole = json.loads(read_only_sql_json(spark, "SELECT id AS `a.b` FROM range(20001)"))
    assert sorted(r["a.b"] for r in whole) == list(range(20001))
    with pytest.raises(ValueError):
        next(read_only_pages(spark, "SELECT 1", page_rows=0))


def test_land_files(spark):
    src = tempfile.mkdtemp(prefix="ll-src-")
    lake = tempfile.mkdtemp(prefix="ll-lake-")
    for name, body in [("a.pdf", b"one"), ("b.csv", b"two,three")]:
        with open(os.path.join(src, name), "wb") as f:
            f.write(body)
    rec = land_files(spark, f"{src}/*", lake, "banking", "inbox", "2002-01-01 10:00:00").collect()
    import hashlib
    got = {r.filename: (r.size_bytes, r.sha256) for r in rec}
    assert got == {"a.pdf": (3, hashlib.sha256(b"one").hexdigest()),
                   "b.csv": (9, hashlib.sha256(b"two,three").hexdigest())}
    # landing again the same day replaces that day's partition
    land_files(spark, f"{src}/*", lake, "banking", "inbox", "2002-01-01 11:00:00")
    assert spark.read.parquet(f"{lake}/bronze_files").count() == 2


def test_landing_keeps_the_days_other_files(spark):
    lake = tempfile.mkdtemp(prefix="ll-lake-")
    for name, body in [("a.txt", b"one"), ("b.txt", b"two"), ("a.txt", b"newer")]:
        src = tempfile.mkdtemp(prefix="ll-src-")
        with open(os.path.join(src, name), "wb") as f:
            f.write(body)
        land_files(spark, f"{src}/*", lake, "banking", "inbox", "2002-01-01 10:00:00", extra='{"by":"test"}')
    got = spark.read.parquet(f"{lake}/bronze_files").select("filename", "content", "extra").collect()
    assert {(r.filename, bytes(r.content), r.extra) for r in got} == {("a.txt", b"newer", '{"by":"test"}'), ("b.txt", b"two", '{"by":"test"}')}


def test_inbox_quoted_and_wide_files(spark):
    from pyspark.sql import functions as F
    from ledgerloom.sources.csv_inbox import parse_lines
    wide = ",".join([f"c{i}" for i in range(40)])
    files = {
        "q.csv": ['"Date","Description" ,"Amount\t"', '"2024-01-02","a, ""b"" c","1,234.50"', "20240103,x,2"],
        "w.csv": [wide + ",Date,Description,Amount", ",".join(["z"] * 40) + ",2024-02-01,last,-3.10", "short"],
        "n.csv": ['"Ref, old",Date,Memo,Debit', '"1,2",2024-03-01,m,7'],
    }
    lines = [(f, i, t) for f, ts in files.items() for i, t in enumerate(ts)]
    df = spark.createDataFrame(lines, "source_file string, line_no bigint, text string")
    rows, rejected = parse_lines(df, F.lit("2024-01-01").cast("timestamp_ntz"))
    got = {(r.source_file, str(r.row_date), r.description, str(r.amount)) for r in rows.collect()}
    assert got == {("q.csv", "2024-01-02", 'a, "b" c', "1234.50"), ("q.csv", "2024-01-03", "x", "2.00"),
                   ("w.csv", "2024-02-01", "last", "-3.10"), ("n.csv", "2024-03-01", "m", "7.00")}
    assert [(r.source_file, r.reason) for r in rejected.collect()] == [("w.csv", "blank_date")]


def test_java_calls_are_refused(spark):
    for sql in ("SELECT reflect('java.lang.System','getProperty','user.dir')", "SELECT `java_method`('a','b')"):
        with pytest.raises(ReadOnlyViolation):
            check_read_only(spark, sql)
    assert check_read_only(spark, "SELECT replace(a, 'x', 'y') FROM t")
    assert check_read_only(spark, "SHOW CREATE TABLE t")


def test_inbox_reader_headers_and_rejects(spark):
    from pyspark.sql import functions as F
    from ledgerloom.sources.csv_inbox import parse_lines, read_inbox
    d = tempfile.mkdtemp(prefix="ll-inbox-")
    files = {
        "A1.csv": "\ufeffDate,Description,Amount\n2024-01-02,Coffee,\"1,234.50\"\n2024-13-01,Bad,1.00\n,NoDate,2.00\n2024-01-05,,$3.10\n",
        "A2.csv": "Details,Posted Date,CAD$\nRent,2024-02-01,(12.00)\nGym,2024-02-03,40\n",
        "A3.csv": "When,What,How Much\n2024-01-01,x,1\n",
    }
    for n, body in files.items():
        with open(os.path.join(d, n), "w", encoding="utf-8") as f:
            f.write(body)
    rows, rejected = parse_lines(read_inbox(spark, d), F.lit("2024-03-01 00:00:00").cast("timestamp_ntz"))
    got = sorted((r.account_hint, str(r.row_date), r.description, str(r.amount)) for r in rows.collect())
    assert got == [("A1", "2024-01-02", "Coffee", "1234.50"), ("A1", "2024-01-05", None, "3.10"),
                   ("A2", "2024-02-03", "Gym", "40.00")]
    reasons = sorted(r.reason for r in rejected.collect())
    assert reasons == ["bad_amount", "bad_date", "blank_date", "unrecognised_header"]


def test_rerun_of_a_written_batch_adds_nothing(spark):
    """Details are written before headers; once the headers are in, the hash
    check skips the whole batch on a rerun."""
    from pyspark.sql import functions as F
    from testpaths import SMALL
    from ledgerloom.plans.context import Lake
    from ledgerloom.plans.ingest import first_copies, write_bronze_batch
    from ledgerloom.sources.statements import prior_header_shas
    lake = Lake(spark, SMALL)
    root = tempfile.mkdtemp(prefix="ll-bronze-")
    first = lake.first_copies
    n_first = first.count()
    assert n_first > 0
    write_bronze_batch(first, root)
    bank = spark.read.parquet(f"{root}/bank_statements")
    cc = spark.read.parquet(f"{root}/cc_statements")
    known = prior_header_shas(bank.withColumn("period_start", F.lit("1900-01-01").cast("date")),
                              cc.withColumn("period_start", F.lit("1900-01-01").cast("date")))
    again = first_copies(lake.statement_documents, known.unionByName(lake.prior_header_shas))
    # only multi-account documents without accounts remain (they insert nothing, so they stay new)
    assert again.filter(~((F.col("kind") == "multi") & (F.size("accounts") == 0))).count() == 0


def test_schema_describe(spark):
    from testpaths import SMALL
    from ledgerloom.plans.context import Lake
    from ledgerloom.plans.quality import schema_describe
    rows = schema_describe(Lake(spark, SMALL, materialize=False)).collect()
    fact = [r.column_name for r in rows if r.table_name == "fact_transactions"]
    assert fact[:2] == ["transaction_id", "stable_id"] and len(fact) == 18
    assert {r.layer for r in rows} == {"silver", "gold"}


def test_run_models_writes_tables_and_views(spark):
    from testpaths import SMALL
    from ledgerloom.plans.context import Lake
    from ledgerloom.plans.run import TABLE_MODELS, VIEW_MODELS, run_models
    out = tempfile.mkdtemp(prefix="ll-run-")
    lazy = Lake(spark, SMALL)
    models = run_models(Lake(spark, SMALL), out)
    for layer, name in TABLE_MODELS:
        written = spark.read.parquet(f"{out}/{layer}/{name}")
        assert written.count() == getattr(lazy, name).count(), name
    for name in VIEW_MODELS + [n for _, n in TABLE_MODELS]:
        assert spark.table(name).count() == models[name].count()
    got = json.loads(read_only_sql_json(spark, "SELECT count(*) AS n FROM semantic_transactions"))
    assert got == [{"n": models["fact_transactions"].count()}]


def test_inbox_stream_processes_each_file_once(spark):
    from ledgerloom.streaming.inbox import run_inbox_stream
    base = tempfile.mkdtemp(prefix="ll-stream-")
    inbox = os.path.join(base, "inbox")
    os.makedirs(inbox)

    def drop(name, body):
        with open(os.path.join(inbox, name), "w", encoding="utf-8") as f:
            f.write(body)

    def run():
        run_inbox_stream(spark, inbox, f"{base}/bronze", f"{base}/quarantine", f"{base}/ckpt", f"{base}/archive",
                         "2024-03-01 00:00:00")
        return spark.read.parquet(f"{base}/bronze")

    drop("A1.csv", "Date,Description,Amount\n2024-01-02,Coffee,3.50\n2024-01-03,Tea,2.00\n")
    drop("A2.csv", "Posted Date,Memo,CAD$\n2024-01-04,Bus,2.75\n")
    first = run()
    assert first.count() == 3
    drop("A3.csv", "Date,Details,Debit\n2024-02-01,Rent,900.00\n")
    second = run()  # same checkpoint: only the new file is read
    assert second.count() == 4
    assert sorted(r.account_hint for r in second.collect()) == ["A1", "A1", "A2", "A3"]
    # files of earlier runs were archived out of the inbox (Spark archives a
    # batch's files after it commits, so the latest run's file may linger)
    left = [n for n in os.listdir(inbox) if n.endswith(".csv")]
    assert "A1.csv" not in left and "A2.csv" not in left


@pytest.mark.parametrize("fails_at", range(5))
def test_retry_of_a_broken_batch_neither_doubles_nor_loses_rows(spark, monkeypatch, fails_at):
    from testpaths import SMALL
    from ledgerloom.plans import ingest, sinks
    from ledgerloom.plans.context import Lake
    first = Lake(spark, SMALL).first_copies
    root, writes, write = tempfile.mkdtemp(prefix="ll-batch-"), [], sinks.write_table

    def breaks(df, path):
        writes.append(path)
        if len(writes) == fails_at + 1:
            raise OSError("lost")
        write(df, path)

    monkeypatch.setattr(sinks, "write_table", breaks)
    with pytest.raises(OSError):
        ingest.write_bronze_batch(first, root, "b1")
    monkeypatch.setattr(sinks, "write_table", write)
    # once staged, the retry must not depend on what still looks new
    ingest.write_bronze_batch(first if fails_at == 0 else first.limit(0), root, "b1")
    for name, rows in ingest.BRONZE_TABLES.items():
        want = rows(first)
        got = spark.read.parquet(f"{root}/{name}").select(want.columns)
        assert got.count() == want.count() > 0
        assert got.exceptAll(want).count() == 0


@pytest.mark.parametrize("split", [40, 300, 1 << 20])
def test_quoted_line_breaks_against_the_csv_module(spark, split):
    """Records over line and split borders, quotes inside and behind fields, files that end in an open quote."""
    import csv
    import random
    from ledgerloom.sources.csv_inbox import read_inbox
    rnd, folder = random.Random(split), tempfile.mkdtemp(prefix="ll-quotes-")
    pieces = ["a", "b b", ",", '"x"', '"x\ny"', '"p, ""q""\n\n,r"', '5" pipe', '"z"tail', '""', '"\n"', "é", '"a""\n""b"']
    want = {}
    for n in range(6):
        lines = ['"Date",Memo,Amount'] + [",".join(rnd.choice(pieces) for _ in range(rnd.randint(1, 4))) for _ in range(60 if n < 5 else 1)]
        lines = lines[:1] + ["2024-01-02,plain,1"] * 30 + lines[1:] if n % 2 else lines
        body = "\n".join(lines) + ("\n" if n % 3 else "")
        if n == 4:
            body = body.replace('"Date"', '"Da\nte"', 1) + '"never closed\n,1\n2'
        with open(os.path.join(folder, f"f{n}.csv"), "w", newline="") as f:
            f.write(body)
        want[f"f{n}.csv"] = [r for r in csv.reader(body.splitlines(keepends=True))]
    keys = {"spark.sql.files.maxPartitionBytes": str(split), "spark.sql.files.openCostInBytes": "0", "spark.sql.files.minPartitionNum": "1"}
    before = {k: spark.conf.get(k, None) for k in keys}
    try:
        for k, v in keys.items():
            spark.conf.set(k, v)
        rows = read_inbox(spark, folder).collect()
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    for name, records in want.items():
        own = sorted((r.line_no, r.text) for r in rows if r.source_file == name)
        assert own[0][0] == 0
        texts = [own[0][1]] + [t for n, t in own[1:]]
        got = [next(iter(csv.reader(t.splitlines(keepends=True))), []) for t in texts]
        drop = lambda rs: [r for r in rs if r]  # noqa: E731  (blank lines are no records)
        assert sorted(map(str, drop(got))) == sorted(map(str, drop(records))), name

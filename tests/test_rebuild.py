"""Rebuild of the statement tables: failures by document, one switch for all tables."""

import json

import pytest

from ledgerloom.plans import rebuild, table_sets
from ledgerloom.plans.context import Lake
from ledgerloom.plans.rebuild import FAILURES, rebuild_bronze
from ledgerloom.plans.table_sets import TableSet
from ledgerloom.sources.statements import BANK_HEADER_FIELDS, CC_HEADER_FIELDS, RECORD_FIELDS
from testpaths import SMALL

RECEIVED = "sha256 string, source_type string, source_id string, source_order int, finance boolean, body string, extra int"
TABLES = ("bank_statements", "bank_transactions", "cc_statements", "cc_transactions")


@pytest.fixture(scope="module")
def record(spark):
    return Lake(spark, SMALL).statement_documents.select(*RECORD_FIELDS).schema


def bank(kind="bank", n=1, amount=1.5, period_end="2001-01-31"):
    header = {**dict.fromkeys(BANK_HEADER_FIELDS), "account_number": "A1", "period_end": period_end}
    detail = {"account_number": "A1", "posting_date": "2001-01-05", "amount": amount, "description": "x"}
    return {"kind": kind, "accounts": [{"header": {**header, "account_number": f"A{i}"}, "details": [detail, detail]} for i in range(n)]}


def card(period_end="2001-01-31"):
    return {"kind": "cc", "card": {"header": {**dict.fromkeys(CC_HEADER_FIELDS), "period_end": period_end}, "details": []}}


def rows(spark, *documents):
    return spark.createDataFrame([(sha, "local", source, order, True, body if body is None or isinstance(body, str) else json.dumps(body), 7)
                                  for sha, source, order, body in documents], RECEIVED)


def counts(tables):
    return tuple(tables.read(t).count() for t in TABLES)


def test_a_broken_document_fails_alone(spark, tmp_path, record):
    tables = TableSet(spark, str(tmp_path / "set"))
    received = rows(
        spark, ("s1", "two accounts", 0, bank("multi", 2)), ("s1", "copy", 1, bank("multi", 2)), ("s1", "copy", 1, bank("multi", 2)),
        ("s2", "card", 0, card()), ("s3", "cut off", 0, json.dumps(bank())[:-4]), ("s4", "no body", 0, None),
        ("s5", "other kind", 0, {"kind": "fax"}), ("s6", "no kind", 0, {"issues": []}), ("s7", "bare", 0, bank(period_end=None)),
        ("s8", "bare card", 0, card(None)), ("s9", "no accounts", 0, bank("multi", 0)), ("s10", "no amount", 0, bank(amount=None)),
        ("s11", "wrong type", 0, bank(amount="much")), (None, "no hash", 0, card()))
    web = spark.createDataFrame([("w", "web", "page", 0, False, "<html>", 7)], RECEIVED)
    assert rebuild_bronze(tables, received.unionByName(web), record) == 1
    assert counts(tables) == (2, 4, 1, 0)
    assert {r.source_id for r in tables.read("bank_statements").collect()} == {"two accounts"}
    assert {r.source_id: r.reason for r in tables.read(FAILURES).collect()} == {
        "cut off": rebuild.UNREADABLE, "no body": rebuild.UNREADABLE, "wrong type": rebuild.UNREADABLE, "other kind": rebuild.NO_KIND,
        "no kind": rebuild.NO_KIND, "bare": rebuild.NO_PERIOD, "bare card": rebuild.NO_PERIOD,
        "no accounts": "multi_account_no_accounts", "no amount": rebuild.NO_AMOUNT, "no hash": rebuild.NO_HASH}


def test_readers_keep_the_old_version_until_the_new_one_is_whole(spark, tmp_path, record, monkeypatch):
    tables = TableSet(spark, str(tmp_path / "set"))
    rebuild_bronze(tables, rows(spark, ("s1", "a", 0, bank())), record)
    before, write, written = counts(tables), table_sets.write_table, []

    def dies(df, path, partition_by=None):
        if len(written) == 3:
            raise RuntimeError("lost")
        written.append(path)
        write(df, path, partition_by)

    monkeypatch.setattr(table_sets, "write_table", dies)
    two = rows(spark, ("s1", "a", 0, bank()), ("s2", "b", 0, card()))
    with pytest.raises(RuntimeError):
        rebuild_bronze(tables, two, record)
    assert counts(tables) == before == (1, 2, 0, 0)
    monkeypatch.undo()
    rebuild_bronze(tables, two, record)
    assert counts(tables) == (1, 2, 1, 0)
    rebuild_bronze(tables, two, record)  # from scratch, so nothing doubles
    assert counts(tables) == (1, 2, 1, 0)


def test_nothing_received(spark, tmp_path, record):
    tables = TableSet(spark, str(tmp_path / "set"))
    rebuild_bronze(tables, spark.createDataFrame([], RECEIVED), record)
    assert counts(tables) == (0, 0, 0, 0) and tables.read(FAILURES).count() == 0

"""Typed seed files."""

import datetime

import pytest

from ledgerloom.plans.context import Lake
from ledgerloom.sources.seeds import read_seed, read_seeds
from testpaths import SMALL

ACCOUNTS = """account_id,friendly_name,inversion_factor,is_active,expected_frequency,start_date,extra
0012,"Main, ""joint""
account",1,true,monthly,2022-01-31,5
0013,Card,-1,false,,,
0014,Bad factor,one,true,monthly,2022-01-01,7
0015,Bad both,1.5,maybe,monthly,2022-02-30,8
0016,Too short,1
0017,Too long,1,true,monthly,2022-01-01,9,10
"""
OTHERS = {"dim_holders": "holder_raw,owner\nA B,ann\n007,bob\n", "dim_category_overrides": "stable_id,category_id,notes\n",
          "dim_transfer_rules": "rule_id,pattern,direction,notes\nt1,%wire%,outbound,\n",
          "dim_category_rules": "rule_id,category_id,pattern,priority\nz9,fuel,pump,5\na1,dining,pump house,5\n",
          "dim_categories": "category_id,category_name,parent_category_id\nfuel,Fuel,transport\n"}


@pytest.fixture
def folder(tmp_path):
    for name, text in {"dim_account_normalization": ACCOUNTS, **OTHERS}.items():
        (tmp_path / f"{name}.csv").write_text(text)
    return str(tmp_path)


def test_types_quotes_and_rejects(spark, folder):
    rows, rejects = read_seed(spark, f"{folder}/dim_account_normalization.csv", "dim_account_normalization")
    assert [tuple(r) for r in rows.orderBy("account_id").collect()] == [
        ("0012", 'Main, "joint"\naccount', 1, True, "monthly", datetime.date(2022, 1, 31), 5),
        ("0013", "Card", -1, False, None, None, None)]
    assert dict(rows.dtypes)["start_date"] == "date" and dict(rows.dtypes)["is_active"] == "boolean"
    assert rows.count() == 2
    found = {(r.field, r.value, r.reason) for r in rejects.collect()}
    assert {f for f in found if f[0]} == {
        ("inversion_factor", "one", "not int"), ("inversion_factor", "1.5", "not int"), ("is_active", "maybe", "not boolean"),
        ("start_date", "2022-02-30", "not date")}
    assert {f[1] for f in found if not f[0]} == {"0016,Too short,1", "0017,Too long,1,true,monthly,2022-01-01,9,10"}


def test_missing_declared_column_is_an_error(spark, tmp_path):
    (tmp_path / "h.csv").write_text("holder_raw\nx\n")
    with pytest.raises(ValueError, match="owner"):
        read_seed(spark, str(tmp_path / "h.csv"), "dim_holders")


def test_folder_of_six_seeds(spark, folder):
    rows, rejects = read_seeds(spark, folder)
    assert {k: v.count() for k, v in rows.items()} == {
        "dim_account_normalization": 2, "dim_holders": 2, "dim_category_overrides": 0, "dim_transfer_rules": 1,
        "dim_category_rules": 2, "dim_categories": 1}
    assert [r.holder_raw for r in rows["dim_holders"].orderBy("owner").collect()] == ["A B", "007"]  # declared text stays text
    assert dict(rows["dim_category_rules"].dtypes)["priority"] == "int"
    assert [r.rule_id for r in rows["dim_category_rules"].orderBy("priority", "line").collect()] == ["z9", "a1"]
    assert rejects.count() == 6


def test_models_take_their_seeds_from_a_folder(spark, folder):
    lake = Lake(spark, SMALL, seeds=folder)
    assert {r.account_id for r in lake.dim_account_normalization.collect()} == {"0012", "0013"}
    assert lake.dim_category_overrides.count() == 0
    assert lake.fact_transactions.where("category_source = 'override'").isEmpty()

"""All rules of a set of tables from one scan of each; loads that count them on the way."""

import re

import pytest
from pyspark.sql import functions as F

from ratewright.operators import contracts, quality
from ratewright.operators.quality import TableContract
from ratewright.plans.queries import CONTRACTS, _tables_of
from ratewright.session import scratch_path
from tests.conftest import d
from tests.test_plans import plan_of

PARENT = TableContract("id", ["id", "name"], {"name": ["a", "b"]}, expressions={"positive": "size > 0"}, ranges={"size": (None, 9, False)})
CHILD = TableContract("", ["parent"], references={"parent": ("parents", "id"), "second": ("parents", "id")}, combinations=[["parent", "n"]])


def tables(spark):
    parents = spark.createDataFrame(
        [("1", "a", 5), ("1", "x", -1), ("2", None, 9), (None, "b", None), (None, "b", 1)], "id string, name string, size int"
    )
    children = spark.createDataFrame(
        [("1", "9", 1), ("1", "9", 1), ("3", None, None), ("3", "1", None), (None, "8", 4), (None, "8", 4)],
        "parent string, second string, n int",
    )
    return {"parents": parents, "children": children}


def report(frames, contract, checks=None):
    rows = contracts.contract_report(frames, contract, checks).collect()
    return {(r.table_name, r.check_name, r.rule): r.failing_rows for r in rows}


def test_every_rule_is_counted_by_hand(spark):
    got = report(tables(spark), {"parents": PARENT, "children": CHILD})
    assert got == {
        ("parents", "not_null", "id"): 2,
        ("parents", "not_null", "name"): 1,
        ("parents", "accepted_values", "name"): 1,  # NULL passes
        ("parents", "expression", "positive"): 1,
        ("parents", "accepted_range", "size"): 1,
        ("parents", "unique", "id"): 1,  # NULL ids are not compared
        ("children", "not_null", "parent"): 2,
        ("children", "relationships", "parent"): 1,  # one key, two rows
        ("children", "relationships", "second"): 2,
        ("children", "unique_combination", "parent+n"): 3,  # NULL parts are compared
    }


MONTHS = TableContract(
    "", ["policy"], combinations=[["unit", "month"]], ranges={"days": (1, 31, True)}, lies_by="unit"
)


def months(spark):
    rows = [(1, 1, 31, "p"), (1, 1, 0, None), (1, 1, 5, "p"), (1, 2, 40, None), (2, 1, 1, "q"), (None, 1, 1, "p"), (None, 1, 1, "p")]
    return spark.createDataFrame(rows, "unit bigint, month int, days int, policy string")


def test_months_that_lie_by_a_column_are_counted_in_place(spark):
    from dataclasses import replace

    expected = {
        ("months", "not_null", "policy"): 2, ("months", "accepted_range", "days"): 2,
        ("months", "unique_combination", "unit+month"): 2,  # a key three times, a NULL one twice
    }
    lying = months(spark).repartition(3, "unit")
    assert report({"months": lying}, {"months": MONTHS}) == expected
    assert report({"months": lying}, {"months": replace(MONTHS, lies_by="")}) == expected
    # with references, whose tags are shuffled
    both = {"parents": TableContract("id", []), "months": replace(MONTHS, references={"policy": ("parents", "id")})}
    got = report({**tables(spark), "months": lying}, both)
    assert got == {**expected, ("parents", "unique", "id"): 1, ("months", "relationships", "policy"): 2}
    tree = plan_of(contracts.contract_report({"months": lying}, {"months": MONTHS})).split("\n\n")[0]
    assert "hashpartitioning(unit" not in tree and "Generate" in tree


@pytest.mark.parametrize(
    "kind, values, twice",
    [
        ("bigint", [1, 1, None, None, 2], 1),
        ("date", [d("2020-01-01"), d("2020-01-01"), None, d("2020-01-02")], 1),
        ("string", ["0" * 32, "0" * 32, "A" * 32, "a" * 32, "g" * 32, "g" * 32, "\x00" * 16, None, None], 2),
    ],
)
def test_keys_of_every_type_stay_apart(spark, kind, values, twice):
    df = spark.createDataFrame([(v, i) for i, v in enumerate(values)], f"id {kind}, n int")
    twin = df.withColumn("n", F.lit(7))
    contract = {"t": TableContract("id", []), "u": TableContract("", [], references={"id": ("t", "id")}, combinations=[["id", "n"]])}
    got = report({"t": df, "u": twin}, contract)
    nulls = 1 if values.count(None) > 1 else 0
    assert got == {("t", "unique", "id"): twice, ("u", "relationships", "id"): 0, ("u", "unique_combination", "id+n"): twice + nulls}


def test_numbers_are_found_among_texts(spark):
    contract = {"t": TableContract("id", []), "u": TableContract("", [], references={"id": ("t", "id")})}
    frames = {"t": spark.sql("SELECT '7' AS id"), "u": spark.sql("SELECT explode(array(7, 8)) AS id")}
    assert report(frames, contract) == {("t", "unique", "id"): 0, ("u", "relationships", "id"): 1}


def test_empty_tables_break_nothing(spark):
    empty = {name: df.limit(0) for name, df in tables(spark).items()}
    assert set(report(empty, {"parents": PARENT, "children": CHILD}).values()) == {0}


def test_named_checks_alone(spark):
    got = report(tables(spark), {"parents": PARENT, "children": CHILD}, {"relationships"})
    assert got == {("children", "relationships", "parent"): 1, ("children", "relationships", "second"): 2}


def test_too_many_references_are_refused(spark):
    many = TableContract("", [], references={f"c{i}": ("parents", "id") for i in range(63)})
    frames = {**tables(spark), "children": spark.range(1).select(*[F.lit("1").alias(f"c{i}") for i in range(63)])}
    with pytest.raises(ValueError, match="more than 62"):
        contracts.contract_report(frames, {"parents": PARENT, "children": many})


def test_reports_agree_with_the_single_checks(book):
    frames = _tables_of(book, "raw")
    got = report(frames, CONTRACTS["raw"])
    for table, k in list(CONTRACTS["raw"].items())[:4]:
        for column, (parent, key) in k.references.items():
            assert got[table, "relationships", column] == quality.relationships(frames[table], column, frames[parent], key).count()
        assert got[table, "unique", k.key] == quality.unique(frames[table], k.key).count()


def test_each_table_is_read_once(spark):
    """One scan a table and no join but the one with the list of rules."""
    root = scratch_path(spark, "contract_tables")
    for name, df in tables(spark).items():
        df.write.parquet(f"{root}/{name}")
    frames = {name: spark.read.parquet(f"{root}/{name}") for name in ("parents", "children")}
    tree = plan_of(contracts.contract_report(frames, {"parents": PARENT, "children": CHILD})).split("\n\n")[0]
    tree = tree.split("Initial Plan")[-1]
    assert len(re.findall(r"Scan parquet", tree)) == 2
    assert len(re.findall(r"\bExchange\b", tree)) <= 3 and "Anti" not in tree


def test_a_load_counts_while_it_writes(spark):
    path = scratch_path(spark, "load")
    seen = contracts.observed_load(tables(spark)["parents"], path, PARENT)
    assert seen == {
        ("rows", "written"): 5, ("not_null", "id"): 2, ("not_null", "name"): 1, ("accepted_values", "name"): 1,
        ("expression", "positive"): 1, ("accepted_range", "size"): 1,
    }
    assert spark.read.parquet(path).count() == 5


@pytest.mark.parametrize(
    "periods, faults",
    [
        ([("2020-01-01", "2020-02-01"), ("2020-02-01", "9999-12-31")], []),
        ([("2020-01-01", "2020-02-02"), ("2020-02-01", "9999-12-31")], ["overlap"]),
        ([("2020-01-01", "2020-01-31"), ("2020-02-01", "9999-12-31")], ["gap"]),
        ([("2020-01-01", "2020-01-01"), ("2020-01-01", "9999-12-31")], ["empty"]),
        ([("2020-01-01", "2020-02-01"), ("2020-01-01", "2020-02-01")], ["repeated"]),
        # a long first period covers two later ones: both overlap, though they do not overlap each other
        ([("2020-01-01", "2021-01-01"), ("2020-02-01", "2020-03-01"), ("2020-04-01", "9999-12-31")], ["overlap", "overlap"]),
        ([("2020-01-01", None)], ["empty"]),
    ],
)
def test_period_faults(spark, periods, faults):
    rows = [("c", d(a), b and d(b)) for a, b in periods] + [("other", d("2020-01-15"), d("9999-12-31"))]
    df = spark.createDataFrame(rows, "claim_id string, valid_from_date date, valid_to_date date")
    assert [r.fault for r in quality.state_period_faults(df).orderBy("valid_from_date").collect()] == faults


def test_sound_periods_make_valuations_unique(book):
    assert quality.state_period_faults(book.claim_financial_state_period).count() == 0
    twice = quality.unique_combination(book.claim_valuation_snapshot, ["claim_id", "valuation_date"])
    assert twice.count() == 0

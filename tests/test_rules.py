"""Row rules and field checks against fixed vectors; None stands for a refusal."""

import pytest
from pyspark.sql import functions as F

from lodestrata.functions import rules, validity
from lodestrata.functions.masking import mask

NAMES = [("Smith", "Jane", "Smith, Jane"), ("Smith", "", "Smith, "), ("", "Jane", ", Jane"), ("  Smith  ", "  Jane  ", "Smith, Jane"),
         (None, "Jane", ", Jane"), ("Smith", None, "Smith, "), (None, None, None)]
TYPES = [("Tax", "TAX"), ("tax", "TAX"), ("TAX", "TAX"), ("Labor", "ITEM"), ("", "ITEM"), (None, "ITEM"), ("tax\n", "TAX"), ("tax\t", "TAX"),
         ("tax\r", "TAX"), (" tax ", "TAX")]
TASKS = [("ABC|123", "123"), ("ABC(123)", "ABC(123"), ("PLAIN", "PLAIN"), ("", None), (None, None), ("A|B|C", "B|C"), ("|Z", "Z"), ("X|Y)", "Y"),
         ("AB)123))", "AB)123"), ("ABC", "ABC"), ("  Task | 42 )  ", "42"), ("|sales", "sales"), ("\t", None), ("  ", None), ("\n", None), ("\r", None)]
MODULES = [("TS", "a"), ("ES", "b"), ("MI", "c"), (None, None), ("XX", None), ("ts", "a"), ("ts\n", "a"), (" ts ", "a"), ("mi\t", "c")]


def check(spark, cases, schema, expr):
    df = spark.createDataFrame([(i, *c) for i, c in enumerate(cases)], "i int, " + schema)
    got = [r["got"] for r in df.select("i", expr.alias("got"), "want").orderBy("i").collect()]
    assert got == [c[-1] for c in cases]


def test_worker_name(spark):
    check(spark, NAMES, "last string, first string, want string", rules.worker_name("last", "first"))


def test_line_type(spark):
    check(spark, TYPES, "c string, want string", rules.line_type("c"))


def test_task_number(spark):
    check(spark, TASKS, "c string, want string", rules.task_number("c"))


def test_module_value(spark):
    check(spark, MODULES, "c string, want string", rules.module_value("c", F.lit("a"), F.lit("b"), F.lit("c")))


def test_descriptions(spark):
    got = spark.range(1).select(
        rules.line_description(F.lit("S"), F.lit("J"), F.lit("2026-01-02"), F.lit("r")),
        rules.line_description(F.lit("S"), F.lit("J"), F.lit("2026-01-02"), F.lit("r"), F.lit("inv")),
        rules.line_description(F.lit(""), F.lit(" "), F.lit("2026-01-02"), F.lit("r"))).first()
    assert list(got) == ["S, J|2026-01-02|r", "inv|S, J|2026-01-02|r", None]


def test_amounts_and_fees(spark):
    d = "decimal(18,2)"
    df = spark.sql(f"SELECT * FROM VALUES (0, cast(10 as {d}), cast(9 as {d}), cast(1 as {d}), 'ES'), (1, 9, 9, NULL, 'es '), (2, 9, 9, 1, 'TS'), (3, 9, 9, 0, 'ES') AS t(i, client, supplier, fee, kind)")
    got = [tuple(r) for r in df.orderBy("i").select(rules.client_amount_consistent("client", "supplier", "fee"), rules.fee_violation("kind", "fee")).collect()]
    assert got == [(True, "fee of 1.00 on an expense line"), (True, ""), (False, ""), (True, "")]


def test_references(spark):
    check(spark, [("AEE1IN00123410", "AEE1"), ("AEE1", None), (" AEE1X ", "AEE1"), ("", None), (None, None)], "c string, want string", rules.tenant_of("c"))
    check(spark, [("a|b|c| r ", "r"), ("a|b|c", None), ("a|b|c|", None), ("a|b|c|d|e", "d"), (None, None)], "c string, want string", rules.pipe_field("c"))
    check(spark, [("r", 1, "r#1"), (" r ", 36, "r#36"), ("", 1, None), ("r", 0, None), (None, 2, None)], "c string, n int, want string",
          rules.synthetic_reference("c", "n"))
    check(spark, [(" 12.30\t", "12.30"), ("x", None), ("", None), (None, None), ("-0.1", "-0.10")], "c string, want string", rules.money("c").cast("string"))


@pytest.mark.parametrize("fn, good, bad", [
    (validity.numeric, ["1", " 1.50 ", "-.5", "+2.", "1e5", "1_000", "", None, "12345678901234567890123456789012345678901234567890"],
     ["x", "NaN", "-Infinity", "sNaN", "1,5", "1 2", "--1", "."]),
    (validity.iso_date, ["2021-01-01", "2024-02-29", " 2021-01-01 ", "", None], ["2021-02-30", "2021-1-1", "20210101", "2021-01-01 00:00", "0000-01-01", "2023-02-29"]),
    (validity.present, ["x", " x ", "0"], ["", " ", "\t\n", None, " ", "　  ", "\x1c"]),
    (validity.boolean, ["0", "1", "true", "FALSE", " y ", "N", "", None], ["yes", "2", "t"])])
def test_field_checks(spark, fn, good, bad):
    check(spark, [(v, True) for v in good] + [(v, False) for v in bad], "c string, want boolean", fn("c"))


def test_masks(spark):
    df = spark.createDataFrame([(1, "Jane", 5.0, "t"), (2, None, None, None)], "k int, name string, amount double, tax string")
    masks = {"name": "personal_name", "amount": "money_double", "tax": "tokenised_account"}
    assert [tuple(r) for r in mask(df, masks).collect()] == [(1, "J***", None, None), (2, None, None, None)]
    assert mask(df, masks).schema.simpleString() == df.schema.simpleString()
    assert mask(df, masks, privileged=True).collect() == df.collect()
    with pytest.raises(ValueError):
        mask(df, {"nope": "money"})
    with pytest.raises(ValueError):
        mask(df, {"name": "nope"})

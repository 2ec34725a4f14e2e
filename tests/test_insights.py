"""Every channel and tax type of the data has its flag."""

import pytest

from revenuelake.operators import insights


def made(spark, rows):
    schema = "ts timestamp_ntz, payment_channel string, tax_type string, amount double, risk_flag boolean"
    two = spark.createDataFrame(rows, "payment_channel string, tax_type string")
    return two.selectExpr("timestamp_ntz'2024-01-06 10:00:00' ts", "*", "1.0D amount", "false risk_flag").to(
        spark.createDataFrame([], schema).schema
    )


def test_unseen_categories_have_flags(spark):
    table = made(spark, [("Barter", "Salt Tax"), ("Cash", "VAT"), ("cash", None), (None, "VAT")])
    found = [insights.categories(table, c) for c in ("payment_channel", "tax_type")]
    assert found == [["Barter", "Cash", "cash"], ["Salt Tax", "VAT"]]
    flags = insights.feature_columns(*found)[4:]
    assert flags == ["channel_barter", "channel_cash", "type_salt_tax", "type_vat"]
    got = sorted(tuple(r) for r in insights.transaction_features(table).select(flags).collect())
    assert got == [(0, 0, 0, 1), (0, 1, 0, 0), (0, 1, 0, 1), (1, 0, 1, 0)]


def test_values_without_a_flag_are_errors(spark):
    table = made(spark, [("Barter", "VAT")])
    with pytest.raises(Exception, match="no flag for payment_channel Barter"):
        insights.transaction_features(table, ["Cash"], ["VAT"]).collect()
    with pytest.raises(ValueError, match="more than 1 values"):
        insights.categories(made(spark, [("a", "x"), ("b", "x")]), "payment_channel", limit=1)

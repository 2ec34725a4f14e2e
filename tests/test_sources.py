import datetime as dt

import pytest

import golden
from conftest import rows_by
from revenuelake.operators import quality
from revenuelake.plans import elt
from revenuelake.sources import readers, writers


def write_csv(path, rows):
    names = list(dict.fromkeys(k for r in rows for k in r))
    lines = [",".join(names)] + [",".join("" if r.get(n) is None else f'"{r[n]}"' for n in names) for r in rows]
    path.write_text("\n".join(lines) + "\n")


def test_read_csv_coerces_dates_and_fills_defaults(spark, tmp_path):
    path = tmp_path / "taxpayers.csv"
    write_csv(
        path,
        [
            dict(tin="T-1", taxpayer_id="A", name='Quote "" and, comma', registration_date="2020-01-15", employee_count="25.0", annual_turnover="5000000.5"),
            dict(tin="T-2", taxpayer_id="B", name="b", registration_date="not a date", employee_count=None, annual_turnover=None),
        ],
    )
    rows = rows_by(readers.read_csv_table(spark, "taxpayers", str(path)), "taxpayer_id")
    assert rows["A"]["registration_date"] == dt.date(2020, 1, 15)
    assert rows["B"]["registration_date"] is None
    assert (rows["A"]["employee_count"], float(rows["A"]["annual_turnover"])) == (25, 5000000.5)
    assert rows["A"]["name"] == 'Quote " and, comma'
    assert (rows["A"]["risk_category"], float(rows["A"]["compliance_score"])) == ("Low", 0.75)


def test_unknown_column_is_an_error(spark, tmp_path):
    path = tmp_path / "payments.csv"
    write_csv(path, [dict(payment_id="1", surprise="x")])
    with pytest.raises(ValueError):
        readers.read_csv_table(spark, "payments", str(path))


def test_files_with_another_header_are_an_error(spark, tmp_path):
    folder = tmp_path / "vat_returns"
    folder.mkdir()
    (folder / "a.csv").write_text("return_id,taxpayer_id,status\nA1,T1,Filed\n")
    (folder / "b.csv").write_text("taxpayer_id,return_id,status\nT2,B2,Filed\n")
    with pytest.raises(Exception, match="header|CSV"):
        readers.read_csv_table(spark, "vat_returns", str(folder)).collect()


def test_written_texts_come_back(table, spark, tmp_path):
    texts = ["two\nlines", " blanks ", 'quote " and, comma', "back\\slash \\n", "cr\r\n", "\\\\"]
    alerts = table("fraud_alerts", [dict(alert_id=i, description=d) for i, d in enumerate(texts)])
    writers.write_csv(alerts, str(tmp_path / "alerts"))
    back = rows_by(readers.read_csv_table(spark, "fraud_alerts", str(tmp_path / "alerts"), escaped=True), "alert_id")
    assert [back[i]["description"] for i in range(len(texts))] == texts


def test_overwrite_turns_nan_into_null(spark, tmp_path):
    df = spark.createDataFrame([(1, float("nan")), (2, 2.0)], "id int, v double")
    writers.overwrite_table(df, str(tmp_path / "t"))
    writers.overwrite_table(df, str(tmp_path / "t"))
    assert rows_by(spark.read.parquet(str(tmp_path / "t")), "id") == {1: {"id": 1, "v": None}, 2: {"id": 2, "v": 2.0}}


def test_summary_refresh_replaces_only_given_months(table, spark, tmp_path):
    taxpayers = table("taxpayers", golden.TAXPAYERS)
    path = str(tmp_path / "summary")
    writers.materialize_summary(table("payments", golden.PAYMENTS), taxpayers, path)
    march = [dict(r, amount=1) for r in golden.PAYMENTS if r["payment_date"].startswith("2023-03")]
    writers.materialize_summary(table("payments", march), taxpayers, path)
    rows = {str(r["date"]): float(r["total_amount"]) for r in spark.read.parquet(path).collect()}
    assert rows == {"2023-02-15": 75000.0, "2023-02-25": 135000.0, "2023-03-15": 1.0, "2023-04-15": 37500.0}


def test_region_districts(table, spark):
    regions = table("regions", [dict(region_id=1, region_name="North", districts=["a", "b"]), dict(region_id=2, region_name="South", districts=["c"])])
    assert [tuple(r) for r in readers.region_districts(regions).orderBy("district").collect()] == [
        (1, "North", "a"), (1, "North", "b"), (2, "South", "c"),
    ]


def test_daily_load(spark, tmp_path):
    source, target = tmp_path / "csv", tmp_path / "store"
    source.mkdir()
    empty = {
        "companies_registry": dict(company_reg_no="C1", taxpayer_id="TP000001"),
        "vehicle_registry": dict(vehicle_reg_no="V1", taxpayer_id="TP000001", purchase_value=5),
        "land_registry": dict(property_id="L1", taxpayer_id="TP000002", valuation=7),
    }
    files = {"taxpayers": golden.TAXPAYERS, "paye_returns": golden.PAYE, "vat_returns": golden.VAT, "payments": golden.PAYMENTS, "fraud_alerts": golden.ALERTS}
    for name, rows in {**files, **{k: [v] for k, v in empty.items()}}.items():
        write_csv(source / f"{name}.csv", rows)
    marts = elt.run_daily_load(spark, str(source), str(target), dt.date(2023, 6, 1))
    profile = rows_by(marts.taxpayer_360, "taxpayer_id")
    assert profile["TP000002"]["risk_category_calculated"] == "Critical"
    assert profile["TP000001"]["companies_owned"] == 1
    assert float(rows_by(marts.taxpayers, "taxpayer_id")["TP000002"]["compliance_score"]) == 0.1
    assert marts.revenue_dashboard_metrics.filter("metric_type = 'monthly_revenue'").count() == 3
    assert [r["alert_id"] for r in marts.fraud_detection_alerts.orderBy("alert_id").collect()] == list(
        range(1, marts.fraud_detection_alerts.count() + 1)
    )
    assert spark.table("stg_payments").count() == 4
    (source / "paye_returns.csv").write_text("return_id,taxpayer_id,status\nX,NOBODY,Filed\n")
    with pytest.raises(ValueError, match="relationships"):
        elt.run_daily_load(spark, str(source), str(target), dt.date(2023, 6, 1))


def test_rejects_hold_what_a_load_cannot_take(spark, tmp_path):
    head = "payment_id,taxpayer_id,payment_date,amount,period_year,status\n"
    lines = [
        'P1,A,2001-02-03,10.50,2001,Completed', 'P2,A,2001-02-30,1,2001,Completed', 'P3,A,2001-02-03,ten,x,Completed', ',A,2001-02-03,1,2001,"a, ""b"""',
        'P5,A,2001-02-03,1', 'P6,A,2001-02-03,1,2001,Completed,more', 'P7,A,,,,', 'P8,,2001-02-03, 7 ,25.0,',
    ]
    (tmp_path / "payments.csv").write_text(head + "\n".join(lines) + "\n")
    target, path = str(tmp_path / "out"), str(tmp_path / "rejects")
    for _ in range(2):
        writers.copy_csv_load(spark, str(tmp_path), target, ["payments"], path)
    stored, rejected = readers.read_table(spark, target, "payments"), spark.read.parquet(path)
    assert (stored.count(), rejected.count()) == (4, 12)
    rows = rows_by(stored, "payment_id")
    assert {i: (r["taxpayer_id"], r["period_year"], float(r["amount"])) for i, r in rows.items()} == {"P1": ("A", 2001, 10.5), "P8": (None, 25, 7.0)}
    found = {r["record"].split(",")[0].strip('"'): r for r in rejected.collect()}
    assert {i: r["reason"] for i, r in found.items()} == {
        "P2": "malformed payment_date", "P3": "malformed amount; malformed period_year", "": "missing payment_id", "P5": "wrong number of fields",
        "P6": "wrong number of fields", "P7": "missing payment_date; missing amount",
    }
    assert found["P6"]["record"] == lines[5] and {r["table_name"] for r in found.values()} == {"payments"}
    assert all(r["file"].endswith("/payments.csv") for r in found.values())


def test_dates_and_unknown_taxpayers_stop_at_the_gate(table):
    taxpayers = table("taxpayers", [dict(taxpayer_id="A", tin="1", name="a", registration_date="2000-01-01", compliance_score=0.5)])
    good = dict(payment_id="1", taxpayer_id="A", payment_date="2001-01-01", amount=1, reference_number="R", status="Completed")
    for wrong, told in (({}, None), ({"payment_date": None}, "not_null payments.payment_date: 1"), ({"taxpayer_id": "B"}, "relationships payments.taxpayer_id: 1")):
        report = quality.dq_report({"taxpayers": taxpayers, "payments": table("payments", [good | wrong])})
        if told is None:
            quality.require_quality(report)
        else:
            with pytest.raises(ValueError, match=told):
                quality.require_quality(report)

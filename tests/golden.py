"""A small hand-written data set whose expected results are known."""

TAXPAYERS = [
    dict(taxpayer_id="TP000001", tin="T-1", name="Harbour Trading", taxpayer_type="Corporate", registration_date="2020-01-15", email="a@x.org", district="D1", region="North", business_sector="Retail", annual_turnover=5000000, risk_category="Low", compliance_score=0.85),
    dict(taxpayer_id="TP000002", tin="T-2", name="Market Electronics", taxpayer_type="Corporate", registration_date="2019-03-20", email="b@x.org", district="D2", region="North", business_sector="Retail", annual_turnover=12500000, risk_category="High", compliance_score=0.42),
    dict(taxpayer_id="TP000003", tin="T-3", name="River Fish", taxpayer_type="Corporate", registration_date="2018-06-10", email="c@x.org", district="D3", region="North", business_sector="Agriculture", annual_turnover=25000000, risk_category="Medium", compliance_score=0.67),
    dict(taxpayer_id="TP000004", tin="T-4", name="Beach Hotels", taxpayer_type="Corporate", registration_date="2017-11-05", email="d@x.org", district="D4", region="North", business_sector="Services", annual_turnover=45000000, risk_category="Low", compliance_score=0.92),
    dict(taxpayer_id="TP000005", tin="T-5", name="West Motors", taxpayer_type="Corporate", registration_date="2021-02-28", email="e@x.org", district="D5", region="West", business_sector="Retail", annual_turnover=8000000, risk_category="Medium", compliance_score=0.73),
]
PAYE = [
    dict(return_id="P1A", taxpayer_id="TP000001", period_year=2023, period_month=1, filing_date="2023-02-10", due_date="2023-02-15", gross_salaries=500000, status="Filed"),
    dict(return_id="P1B", taxpayer_id="TP000001", period_year=2023, period_month=2, filing_date="2023-03-12", due_date="2023-03-15", gross_salaries=520000, status="Filed"),
    dict(return_id="P2A", taxpayer_id="TP000002", period_year=2023, period_month=1, filing_date="2023-02-20", due_date="2023-02-15", gross_salaries=900000, status="Overdue"),
    dict(return_id="P2B", taxpayer_id="TP000002", period_year=2023, period_month=2, filing_date=None, due_date="2023-03-15", gross_salaries=850000, status="Pending"),
]
VAT = [
    dict(return_id="V1", taxpayer_id="TP000001", period_year=2023, period_quarter=1, filing_date="2023-04-10", due_date="2023-04-15", total_sales=1500000, output_vat=157500, status="Filed"),
    dict(return_id="V2", taxpayer_id="TP000002", period_year=2023, period_quarter=1, filing_date="2023-04-20", due_date="2023-04-15", total_sales=3000000, output_vat=315000, status="Overdue"),
    dict(return_id="V3", taxpayer_id="TP000003", period_year=2023, period_quarter=1, filing_date="2023-04-05", due_date="2023-04-15", total_sales=6000000, output_vat=180000, status="Filed"),
]
PAYMENTS = [
    dict(payment_id="Y1", taxpayer_id="TP000001", payment_date="2023-02-15", payment_channel="Bank Transfer", tax_type="PAYE", amount=75000, reference_number="P1A", status="Completed"),
    dict(payment_id="Y2", taxpayer_id="TP000001", payment_date="2023-03-15", payment_channel="Mobile Money", tax_type="PAYE", amount=78000, reference_number="P1B", status="Completed"),
    dict(payment_id="Y3", taxpayer_id="TP000001", payment_date="2023-04-15", payment_channel="Bank Transfer", tax_type="VAT", amount=37500, reference_number="V1", status="Completed"),
    dict(payment_id="Y4", taxpayer_id="TP000002", payment_date="2023-02-25", payment_channel="Bank Transfer", tax_type="PAYE", amount=135000, reference_number="P2A", status="Completed"),
]
ALERTS = [
    dict(alert_id=1, taxpayer_id="TP000002", alert_date="2023-05-01", alert_type="Sudden VAT Declaration Drop", risk_score=0.87, status="Open"),
    dict(alert_id=2, taxpayer_id="TP000002", alert_date="2023-05-01", alert_type="Multiple Late Payments", risk_score=0.75, status="Open"),
]

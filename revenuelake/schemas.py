"""Explicit schemas of the input tables; readers never infer types."""

from pyspark.sql.types import (
    ArrayType, BooleanType, DataType, DateType, DecimalType, IntegerType, LongType, StringType, StructField,
    StructType, TimestampType,
)

MONEY = "DECIMAL(15,2)"

_TYPES: dict[str, DataType] = {
    "STRING": StringType(),
    "INT": IntegerType(),
    "BIGINT": LongType(),
    "BOOLEAN": BooleanType(),
    "DATE": DateType(),
    "TIMESTAMP": TimestampType(),
    "DECIMAL(15,2)": DecimalType(15, 2),
    "DECIMAL(10,2)": DecimalType(10, 2),
    "DECIMAL(5,2)": DecimalType(5, 2),
    "DECIMAL(3,2)": DecimalType(3, 2),
    "ARRAY<STRING>": ArrayType(StringType()),
}


def _schema(text: str) -> StructType:
    """Columns as ``name TYPE`` pairs; needs no session, so workers can import this module too."""
    words = text.replace(", ", " ").replace(",\n", " ").split()
    return StructType([StructField(name, _TYPES[kind]) for name, kind in zip(words[::2], words[1::2])])


SCHEMAS: dict[str, StructType] = {
    "taxpayers": _schema(
        f"""taxpayer_id STRING, tin STRING, name STRING, taxpayer_type STRING, registration_date DATE,
        email STRING, phone STRING, address_line1 STRING, address_line2 STRING, district STRING,
        region STRING, business_sector STRING, business_subsector STRING, employee_count INT,
        annual_turnover {MONEY}, risk_category STRING, compliance_score DECIMAL(3,2),
        created_at TIMESTAMP, updated_at TIMESTAMP"""
    ),
    "paye_returns": _schema(
        f"""return_id STRING, taxpayer_id STRING, period_year INT, period_month INT, filing_date DATE,
        due_date DATE, employee_count INT, gross_salaries {MONEY}, paye_tax {MONEY},
        social_security {MONEY}, total_deductions {MONEY}, net_payment {MONEY}, status STRING,
        created_at TIMESTAMP"""
    ),
    "vat_returns": _schema(
        f"""return_id STRING, taxpayer_id STRING, period_year INT, period_quarter INT, filing_date DATE,
        due_date DATE, total_sales {MONEY}, taxable_sales {MONEY}, exempt_sales {MONEY},
        export_sales {MONEY}, output_vat {MONEY}, total_purchases {MONEY}, input_vat {MONEY},
        net_vat_payable {MONEY}, status STRING, created_at TIMESTAMP"""
    ),
    "corporate_tax": _schema(
        f"""assessment_id STRING, taxpayer_id STRING, tax_year INT, filing_date DATE, due_date DATE,
        gross_income {MONEY}, deductible_expenses {MONEY}, taxable_income {MONEY},
        tax_rate DECIMAL(5,2), tax_liability {MONEY}, tax_credits {MONEY}, net_tax_payable {MONEY},
        status STRING, created_at TIMESTAMP"""
    ),
    "payments": _schema(
        f"""payment_id STRING, taxpayer_id STRING, payment_date DATE, payment_channel STRING,
        payment_provider STRING, tax_type STRING, period_year INT, period_month INT, amount {MONEY},
        reference_number STRING, status STRING, created_at TIMESTAMP"""
    ),
    "companies_registry": _schema(
        f"""company_reg_no STRING, company_name STRING, taxpayer_id STRING, incorporation_date DATE,
        company_type STRING, share_capital {MONEY}, directors_count INT, business_activity STRING,
        status STRING, last_filing_date DATE, created_at TIMESTAMP"""
    ),
    "vehicle_registry": _schema(
        f"""vehicle_reg_no STRING, taxpayer_id STRING, vehicle_type STRING, make STRING, model STRING,
        year INT, engine_capacity INT, purchase_date DATE, purchase_value {MONEY},
        import_duty_paid {MONEY}, created_at TIMESTAMP"""
    ),
    "land_registry": _schema(
        f"""property_id STRING, taxpayer_id STRING, property_type STRING, location STRING,
        size_sqm DECIMAL(10,2), valuation {MONEY}, acquisition_date DATE, transfer_tax_paid {MONEY},
        annual_property_tax {MONEY}, created_at TIMESTAMP"""
    ),
    "regions": _schema("region_id INT, region_name STRING, districts ARRAY<STRING>"),
    "fraud_alerts": _schema(
        """alert_id BIGINT, taxpayer_id STRING, alert_date DATE, alert_type STRING,
        risk_score DECIMAL(3,2), description STRING, status STRING, investigated_by STRING,
        investigation_notes STRING, created_at TIMESTAMP"""
    ),
    "revenue_forecasts": _schema(
        f"""forecast_date DATE, tax_type STRING, predicted_revenue {MONEY}, lower_bound {MONEY},
        upper_bound {MONEY}, created_at TIMESTAMP"""
    ),
    "realtime_transactions": _schema(
        f"""transaction_id STRING, taxpayer_id STRING, ts TIMESTAMP, payment_channel STRING,
        amount {MONEY}, tax_type STRING, status STRING, risk_flag BOOLEAN"""
    ),
}

# Columns declared NOT NULL besides the keys.
REQUIRED: dict[str, list[str]] = {
    "taxpayers": ["tin", "name", "registration_date"],
    "paye_returns": ["period_year", "period_month", "due_date"],
    "vat_returns": ["period_year", "period_quarter", "due_date"],
    "corporate_tax": ["tax_year", "due_date"],
    "payments": ["payment_date", "amount"],
    "companies_registry": ["company_name"],
    "fraud_alerts": ["alert_date"],
    "regions": ["region_name"],
}

PRIMARY_KEYS: dict[str, list[str]] = {
    "taxpayers": ["taxpayer_id"],
    "paye_returns": ["return_id"],
    "vat_returns": ["return_id"],
    "corporate_tax": ["assessment_id"],
    "payments": ["payment_id"],
    "companies_registry": ["company_reg_no"],
    "vehicle_registry": ["vehicle_reg_no"],
    "land_registry": ["property_id"],
    "regions": ["region_id"],
    "fraud_alerts": ["alert_id"],
    "revenue_forecasts": ["forecast_date", "tax_type"],
    "realtime_transactions": ["transaction_id"],
}

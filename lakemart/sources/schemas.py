"""Declared gold schemas and conforming to them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

# The declared columns and types of the gold tables.
GOLD = {
    "dim_date": "Date date, Date_Key int, Year int, Month_Number int, Month_Name string, Month_Short string, "
    "Quarter_Number int, quarter string, Year_Quarter string, Month_Year string, Year_Month string, "
    "Week_Number int, Day int, Day_Name string, Day_Short string, Day_Of_Week int, Day_Of_Year int, "
    "Is_Weekend int, Is_Month_Start int, Is_Month_End int, Is_Quarter_Start int, Is_Quarter_End int, "
    "Is_Year_Start int, Is_Year_End int, Financial_Year string, Financial_Quarter string",
    "dim_branch": "branch_key bigint, branch_id string, branch_name string, city string, state string, "
    "region string, opened_date date, is_active int",
    "dim_customer": "customer_key bigint, customer_id string, full_name string, gender string, dob date, "
    "city string, state string, segment string, risk_rating string, home_branch_id string, "
    "kyc_status string, record_source string, load_ts timestamp",
    "dim_account": "account_key bigint, account_id string, customer_id string, branch_id string, "
    "account_type string, currency string, open_date date, status string, overdraft_limit decimal(18,2), "
    "record_source string, load_ts timestamp",
    "dim_card": "card_key bigint not null, card_id string, customer_id string, linked_account_id string, "
    "card_type string, status string, issued_date date, credit_limit decimal(18,2)",
    "dim_loan": "loan_key bigint, loan_id string, customer_id string, branch_id string, loan_type string, "
    "start_date date, tenure_months int, principal_amount decimal(18,2), interest_rate_apr double, status string",
    "dim_channel": "channel_key bigint, channel_name string",
    "dim_txn_type": "txn_type_key bigint, txn_type_name string",
    "fact_transactions": "account_key bigint, branch_key bigint, channel_key bigint, counterparty string, "
    "currency string, customer_key bigint, date_key int, direction string, is_fraud_label int, "
    "merchant_category string, transaction_id string, transaction_ts timestamp, txn_type_key bigint, "
    "amount decimal(18,2)",
    "fact_daily_balances": "account_key bigint, customer_key bigint, branch_key bigint, date_key int, "
    "snapshot_date date, end_of_day_balance decimal(18,2), currency string",
    "fact_loans": "loan_key bigint, date_key int, customer_key bigint, branch_key bigint, "
    "principal_amount decimal(18,2), interest_rate_apr decimal(10,4), tenure_months int, status string",
    "fact_loan_payments": "branch_key bigint, customer_key bigint, date_key int, loan_key bigint, "
    "payment_amount decimal(19,2), payment_id string, status string",
    "fact_branch_daily_summary": "date_key int, branch_key bigint, total_balance decimal(28,2), "
    "total_accounts bigint, total_customers bigint",
    "fact_customer_daily_portfolio": "customer_key bigint, date_key int, loan_count bigint, "
    "total_principal_amount decimal(28,2), avg_interest_rate_apr decimal(14,8), avg_tenure_months double",
    "dq_results": "table_name string, rule_name string, row_count bigint, batch_id string, execution_ts timestamp",
}


def gold_schema(table: str) -> StructType:
    return StructType.fromDDL(GOLD[table])


def conform(df: DataFrame, schema: StructType, fill: bool = False) -> DataFrame:
    """Exactly the declared columns, in order and type.

    A declared column that is absent is an error unless ``fill`` is set and it may
    be NULL; columns that are not declared are dropped.
    """
    columns = []
    missing = []
    for field in schema.fields:
        if field.name in df.columns:
            columns.append(F.col(field.name).cast(field.dataType).alias(field.name))
        elif fill and field.nullable:
            columns.append(F.lit(None).cast(field.dataType).alias(field.name))
        else:
            missing.append(field.name)
    if missing:
        raise ValueError(f"columns missing for the declared schema: {', '.join(missing)}")
    return df.select(*columns)


def undeclared(df: DataFrame, schema: StructType) -> list[str]:
    return [c for c in df.columns if c not in schema.fieldNames()]

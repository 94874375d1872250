"""Column contracts of the four sources and of the tables built from them."""

from __future__ import annotations

from pyspark.sql import types as T

CUSTOMER = "Customer_ID"
SNAPSHOT = "snapshot_date"
KEYS = [CUSTOMER, SNAPSHOT]

CLICKSTREAM_FEATURES = [f"fe_{i}" for i in range(1, 21)]

# Silver column types per source.
LOAN_TYPES = {
    "loan_id": "string",
    "Customer_ID": "string",
    "loan_start_date": "date",
    "tenure": "int",
    "installment_num": "int",
    "loan_amt": "float",
    "due_amt": "float",
    "paid_amt": "float",
    "overdue_amt": "float",
    "balance": "float",
    "snapshot_date": "date",
}
ATTRIBUTE_TYPES = {
    "Customer_ID": "string",
    "Age": "int",
    "Occupation": "string",
}
FINANCIAL_TYPES = {
    "Customer_ID": "string",
    "Annual_Income": "float",
    "Monthly_Inhand_Salary": "float",
    "Num_Bank_Accounts": "int",
    "Num_Credit_Card": "int",
    "Interest_Rate": "int",
    "Num_of_Loan": "int",
    "Type_of_Loan": "string",
    "Delay_from_due_date": "int",
    "Num_of_Delayed_Payment": "int",
    "Changed_Credit_Limit": "float",
    "Num_Credit_Inquiries": "int",
    "Credit_Mix": "string",
    "Outstanding_Debt": "float",
    "Credit_Utilization_Ratio": "float",
    "Credit_History_Age": "double",
    "Payment_of_Min_Amount": "string",
    "Total_EMI_per_month": "float",
    "Amount_invested_monthly": "float",
    "Payment_Behaviour": "string",
    "Monthly_Balance": "float",
}
CLICKSTREAM_TYPES = {"Customer_ID": "string", **dict.fromkeys(CLICKSTREAM_FEATURES, "float")}

# Identity columns that never reach a feature table.
PII = ["Name", "SSN"]


def raw_schema(types: dict[str, str], extra: list[str] = ()) -> T.StructType:
    """All-string schema, so one dirty value never changes how a column is read."""
    names = [*types, *extra]
    if SNAPSHOT not in names:
        names.append(SNAPSHOT)
    return T.StructType([T.StructField(n, T.StringType()) for n in names])


RAW_LOANS = raw_schema(LOAN_TYPES)
RAW_ATTRIBUTES = T.StructType(
    [T.StructField(n, T.StringType()) for n in [CUSTOMER, "Name", "Age", "SSN", "Occupation", SNAPSHOT]]
)
RAW_FINANCIALS = raw_schema(FINANCIAL_TYPES)
RAW_CLICKSTREAM = raw_schema(CLICKSTREAM_TYPES)

RAW_SCHEMAS = {
    "loan_daily": RAW_LOANS,
    "attributes": RAW_ATTRIBUTES,
    "financials": RAW_FINANCIALS,
    "clickstream": RAW_CLICKSTREAM,
}

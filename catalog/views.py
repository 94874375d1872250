"""The star-schema tables seen as the four raw sources, and SQL for the layers built on them.

The raw views are written once, in SQL both engines read, because they only shape inputs:
all columns are text, with the stray characters, blanks and gaps the cleaning is for. The
silver and gold views below them exist in SQL only; the Spark side runs the package.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskmart.functions.encoding import OCCUPATIONS, UNKNOWN_OCCUPATION
from riskmart.operators.features import CLAMP_COLUMNS, COUNT_COLUMNS
from riskmart.schemas import CLICKSTREAM_FEATURES, FINANCIAL_TYPES
from riskmart.sources.scratch import Staging

TABLES = ["customer", "orders", "lineitem", "events", "part"]

# The months taken to have clickstream data.
VALID_SNAPSHOTS = [f"{year}-{month:02d}-01" for year in (1997, 1998) for month in range(1, 13)][:18]
TRAIN_END = "1999-06-01"

# Every known occupation as people write it, a gap, and one that is not known.
_JOBS = ",".join([*[job.title() for job in OCCUPATIONS], "_______", " Astronaut "])


def _money(value: str) -> str:
    return f"cast(cast({value} as decimal(18, 2)) as string)"


RAW = {
    "lines": """
        select o_custkey, o_totalprice, cast(date_trunc('month', o_orderdate) as date) as opened,
               l_linenumber, l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus,
               cast(l_shipdate as date) as shipped
        from lineitem join orders on l_orderkey = o_orderkey""",
    "raw_loans_daily": f"""
        select 'CUS_0x' || cast(o_custkey as string) || '_' || replace(cast(opened as string), '-', '_') as loan_id,
               ' CUS_0x' || cast(o_custkey as string) || ' ' as Customer_ID,
               cast(opened as string) as loan_start_date,
               '10' as tenure,
               case when l_linenumber = 3 then '3.0' else cast(l_linenumber as string) end as installment_num,
               {_money("l_extendedprice")} as loan_amt,
               case when l_discount = 0 then '0' when l_discount = 0.01 then '0.0' || cast(1 + l_linenumber % 4 as string)
                    else {_money("l_quantity")} end as due_amt,
               case when l_linestatus = 'O' then '' else {_money("l_quantity")} end as paid_amt,
               {_money("case when l_returnflag = 'R' then l_quantity * l_tax * case when l_discount = 0.01 then 250 else 50 end "
                       "else 0 end")} as overdue_amt,
               {_money("l_extendedprice")} as balance,
               cast(shipped as string) as snapshot_date
        from lines""",
    "raw_loans": """
        select loan_id, Customer_ID, loan_start_date, tenure, installment_num, loan_amt, due_amt, paid_amt,
               overdue_amt, balance,
               cast(cast(date_trunc('month', cast(snapshot_date as date)) as date) as string) as snapshot_date
        from raw_loans_daily""",
    "customer_months": """
        select o_custkey, opened, count(*) as n, max(o_totalprice) as price, min(l_extendedprice) as low_price,
               max(l_extendedprice) as high_price, cast(min(l_quantity) as int) as low_qty,
               cast(max(l_quantity) as int) as high_qty, max(l_linenumber) as line, min(l_returnflag) as flag,
               count(case when l_returnflag = 'R' then 1 end) as returned,
               count(case when l_linestatus = 'O' then 1 end) as unfilled,
               cast(round(max(l_tax) * 1000) as int) as tax, max(l_discount) as discount
        from lines group by o_custkey, opened""",
    "raw_financials": f"""
        select 'CUS_0x' || cast(o_custkey as string) as Customer_ID,
               {_money("price")} || case when unfilled > returned then '_' else '' end as Annual_Income,
               case when n = 1 then '' else {_money("low_price")} end as Monthly_Inhand_Salary,
               cast(line - 2 as string) as Num_Bank_Accounts,
               cast(line - 3 as string) as Num_Credit_Card,
               cast(high_qty as string) || '%' as Interest_Rate,
               cast(n - 2 as string) || case when returned > 0 then '_' else '' end as Num_of_Loan,
               case flag when 'A' then 'Auto Loan, Student Loan, and Auto Loan'
                         when 'N' then 'Not Specified, and Payday Loan' end as Type_of_Loan,
               cast(low_qty - 3 as string) as Delay_from_due_date,
               cast(returned as string) || '_' as Num_of_Delayed_Payment,
               case when discount = 0 then '_' else cast(tax - 55 as string) end as Changed_Credit_Limit,
               cast(unfilled as string) || '.0' as Num_Credit_Inquiries,
               case when line < 3 then '_' when line < 5 then 'Bad' when line = 5 then ' Good ' else 'Standard' end
                   as Credit_Mix,
               {_money("high_price")} as Outstanding_Debt,
               cast(low_qty as string) || '.25' as Credit_Utilization_Ratio,
               case when returned = 0 then 'NA'
                    else cast(line as string) || ' Years and ' || cast(n as string) || ' Months' end
                   as Credit_History_Age,
               case flag when 'A' then 'Yes' when 'N' then 'No' else 'NM' end as Payment_of_Min_Amount,
               cast(high_qty * 25 as string) || '.5' as Total_EMI_per_month,
               '__' || cast(low_qty * 7 as string) || '__' as Amount_invested_monthly,
               case when n = 1 then '!@9#%8'
                    else case when high_qty >= 45 then 'High' else 'Low' end || '_spent_'
                         || case when low_qty < 5 then 'Small' when low_qty < 12 then 'Medium' else 'Large' end
                         || '_value_payments' end as Payment_Behaviour,
               {_money("price - high_price")} as Monthly_Balance,
               cast(opened as string) as snapshot_date
        from customer_months""",
    "raw_attributes": f"""
        select 'CUS_0x' || cast(c_custkey as string) || ' ' as Customer_ID, c_name as Name,
               case when c_acctbal > 9000 then '-500' else cast(c_nationkey + 18 as string) end
                   || case when c_mktsegment = 'MACHINERY' then '_' else '' end as Age,
               'id ' || cast(c_custkey as string) as SSN,
               split_part('{_JOBS}', ',', c_nationkey % {len(OCCUPATIONS) + 2} + 1) as Occupation,
               cast(opened as string) as snapshot_date
        from customer join customer_months on c_custkey = o_custkey""",
    "event_hours": "select user_id, "
    + ", ".join(f"max(case when hour(ts) % 20 = {i - 1} then value end) as h{i}" for i in range(1, 21))
    + " from events group by user_id",
    "raw_clickstream": "select 'CUS_0X' || cast(user_id as string) as Customer_ID, "
    + ", ".join(f"{_money(f'h{i}')} as fe_{i}" for i in range(1, 20))
    + f", case when h20 > 50 then 'n/a' else {_money('h20')} end as fe_20, cast(opened as string) as snapshot_date"
    + " from event_hours join customer_months on user_id = o_custkey",
    "orders_by_month": """
        select o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderpriority,
               cast(date_trunc('month', o_orderdate) as date) as snapshot_date from orders""",
    "scored": """
        select l_orderkey, case when l_returnflag = 'R' or l_discount >= 0.09 then 1 else 0 end as label,
               l_discount * 5 + l_tax * 5 as probability,
               case when l_discount * 5 + l_tax * 5 > 0.5 then 1 else 0 end as prediction
        from lineitem""",
}


def _duck_number(column: str) -> str:
    return f"try_cast(regexp_replace({column}, '[^0-9.\\-]', '', 'g') as double)"


def duck_int(column: str) -> str:
    return f"cast(trunc({_duck_number(column)}) as integer)"


def duck_float(column: str) -> str:
    return f"cast(cast({_duck_number(column)} as float) as double)"


def duck_category(column: str) -> str:
    return (
        f"case when regexp_replace(coalesce(trim(lower({column})), ''), '[^a-zA-Z0-9]', '', 'g') = '' "
        f"then 'na' else trim(lower({column})) end"
    )


def duck_loan_list(column: str) -> str:
    parts = f"list_transform(string_split(regexp_replace(lower({column}), '\\band\\b', ',', 'g'), ','), lambda x: trim(x))"
    return f"array_to_string(list_filter({parts}, lambda x, i: x <> '' and list_position({parts}, x) = i), ', ')"


def duck_months(column: str) -> str:
    def part(unit: str) -> str:
        return f"coalesce(try_cast(nullif(regexp_extract({column}, '(\\d+)\\s+{unit}', 1), '') as integer), 0)"

    return f"({part('Years')} * 12 + {part('Months')})"


def duck_round(value: str, digits: int) -> str:
    """Half-up rounding of the decimal form of a double."""
    return f"cast(round(cast(cast({value} as varchar) as decimal(38, 20)), {digits}) as double)"


def _financial(column: str, kind: str) -> str:
    if kind == "int":
        return f"{duck_int(column)} as {column}"
    if kind == "float":
        return f"{duck_float(column)} as {column}"
    special = {
        "Customer_ID": "trim(lower(Customer_ID))",
        "Type_of_Loan": duck_loan_list(f"({duck_category('Type_of_Loan')})"),
        "Credit_History_Age": f"cast({duck_months('Credit_History_Age')} as double)",
        "Payment_of_Min_Amount": "case when trim(lower(Payment_of_Min_Amount)) in ('yes', 'no') "
        "then trim(lower(Payment_of_Min_Amount)) else 'na' end",
        "Payment_Behaviour": "case when regexp_full_match(trim(lower(Payment_Behaviour)), "
        "'(low|high)_spent_(small|medium|large)_value_payments') then trim(lower(Payment_Behaviour)) "
        "else 'unknown' end",
    }
    return f"{special.get(column, duck_category(column))} as {column}"


def _floored(column: str) -> str:
    if column in COUNT_COLUMNS:
        return f"case when {column} >= 0 then cast({column} as double) end as {column}"
    if column == "Changed_Credit_Limit":
        return f"case when {column} >= -50 then {column} end as {column}"
    return f"cast({column} as double) as {column}"


def _ratio(top: str, bottom: str) -> str:
    return f"case when {bottom} > 0 then {duck_round(f'{top} / {bottom}', 4)} end"


def _gold(base: str, extra: list[str]) -> dict[str, str]:
    """SQL of the repaired, clamped, encoded table on top of the view ``base``."""
    others = ["Customer_ID", "Age", "Occupation", "Credit_Mix", "Payment_of_Min_Amount", "Payment_Behaviour",
              "Credit_Utilization_Ratio", *extra, "snapshot_date"]
    fixed = f"select {', '.join(others)}, {', '.join(_floored(c) for c in CLAMP_COLUMNS)} from {base}"
    bounds = "select snapshot_date, " + ", ".join(
        f"quantile_disc({c}, 0.01) as {c}_lo, quantile_disc({c}, 0.99) as {c}_hi" for c in CLAMP_COLUMNS
    ) + f" from {base}_fixed group by snapshot_date"
    clamped = "select " + ", ".join(others) + ", " + ", ".join(
        f"case when {c} < {c}_lo then {c}_lo when {c} > {c}_hi then {c}_hi else {c} end as {c}" for c in CLAMP_COLUMNS
    ) + f" from {base}_fixed join {base}_bounds using (snapshot_date)"
    jobs = sorted([*OCCUPATIONS, UNKNOWN_OCCUPATION])
    known = ", ".join(f"'{job}'" for job in OCCUPATIONS)
    codes = "[" + ", ".join(f"'{job}'" for job in jobs) + "]"
    gold = f"""
        select Customer_ID, Age, Credit_Utilization_Ratio, {', '.join([*CLAMP_COLUMNS, *extra])}, snapshot_date,
               case Credit_Mix when 'bad' then 0 when 'standard' then 1 when 'good' then 2 else -1 end
                   as Credit_Mix_encoded,
               case Payment_of_Min_Amount when 'yes' then 1 when 'no' then 0 else -1 end
                   as Payment_of_Min_Amount_encoded,
               case when Payment_Behaviour like 'low_spent%' then 0 when Payment_Behaviour like 'high_spent%' then 1
                    else -1 end as pb_spent_level,
               case when Payment_Behaviour like '%small_value_payments' then 0
                    when Payment_Behaviour like '%medium_value_payments' then 1
                    when Payment_Behaviour like '%large_value_payments' then 2 else -1 end as pb_payment_size,
               cast(list_position({codes}, case when Occupation in ({known}) then Occupation
                    else '{UNKNOWN_OCCUPATION}' end) - 1 as integer) as Occupation_encoded,
               {_ratio("Outstanding_Debt", "Annual_Income")} as debt_to_income,
               {_ratio("Total_EMI_per_month", "Monthly_Inhand_Salary")} as emi_to_salary,
               {_ratio("Amount_invested_monthly", "Monthly_Inhand_Salary")} as savings_rate,
               Delay_from_due_date * Num_of_Delayed_Payment as payment_stress,
               {_ratio("Num_of_Loan", "Num_Credit_Card")} as loans_per_credit_card,
               {duck_round("(Monthly_Inhand_Salary - Total_EMI_per_month)", 2)} as monthly_surplus
        from {base}_clamped"""
    return {f"{base}_fixed": fixed, f"{base}_bounds": bounds, f"{base}_clamped": clamped, f"{base}_gold": gold}


def _loans(raw: str) -> str:
    return f"""
        select *, case when missed > 0 then cast(snapshot_date - to_months(missed) as date) end as first_missed_date
        from (select loan_id, trim(lower(Customer_ID)) as Customer_ID, cast(loan_start_date as date) as loan_start_date,
                     cast(tenure as integer) as tenure,
                     cast(trunc(cast(installment_num as double)) as integer) as installment_num,
                     cast(cast(loan_amt as float) as double) as loan_amt,
                     cast(cast(due_amt as float) as double) as due_amt,
                     coalesce(cast(try_cast(paid_amt as float) as double), 0) as paid_amt,
                     cast(cast(overdue_amt as float) as double) as overdue_amt,
                     cast(cast(balance as float) as double) as balance,
                     cast(snapshot_date as date) as snapshot_date,
                     cast(trunc(cast(installment_num as double)) as integer) as mob,
                     coalesce(cast(ceil(cast(cast(overdue_amt as float) as double)
                         / nullif(cast(cast(due_amt as float) as double), 0)) as integer), 0) as missed
              from {raw})"""


_LOAN_COLUMNS = """loan_id, Customer_ID, loan_start_date, tenure, installment_num, loan_amt, due_amt, paid_amt,
        overdue_amt, balance, snapshot_date, mob, missed as installments_missed, first_missed_date,
        cast(case when overdue_amt > 0 then date_diff('day', first_missed_date, snapshot_date) else 0 end as integer)
            as dpd"""

# The first missed date may lie before the year 1, so queries give it as days since 1970.
MISSED_DAY = """* exclude (first_missed_date),
    cast(date_diff('day', date '1970-01-01', first_missed_date) as integer) as first_missed_day"""

DUCK = {
    **RAW,
    "loans_daily_dated": _loans("raw_loans_daily"),
    "loans_daily": f"select {_LOAN_COLUMNS} from loans_daily_dated",
    "loans_dated": _loans("raw_loans"),
    "loans": f"select {_LOAN_COLUMNS} from loans_dated",
    "labels_mob6": """
        select loan_id, Customer_ID, case when dpd >= 30 then 1 else 0 end as label, '30dpd_6mob' as label_def,
               snapshot_date from loans where mob = 6""",
    "financials": "select "
    + ", ".join(_financial(c, kind) for c, kind in FINANCIAL_TYPES.items())
    + ", cast(snapshot_date as date) as snapshot_date from raw_financials",
    "attributes": f"""
        select trim(lower(Customer_ID)) as Customer_ID, {duck_int("Age")} as Age,
               {duck_category("Occupation")} as Occupation, cast(snapshot_date as date) as snapshot_date
        from raw_attributes""",
    "clickstream": "select trim(lower(Customer_ID)) as Customer_ID, "
    + ", ".join(f"cast(try_cast({c} as float) as double) as {c}" for c in CLICKSTREAM_FEATURES)
    + ", cast(snapshot_date as date) as snapshot_date from raw_clickstream",
    "base": """
        select f.*, a.Age, a.Occupation from financials f
        left join attributes a on f.Customer_ID = a.Customer_ID and f.snapshot_date = a.snapshot_date""",
    "full_base": "select b.*, "
    + ", ".join(f"c.{c}" for c in CLICKSTREAM_FEATURES)
    + " from base b left join clickstream c on b.Customer_ID = c.Customer_ID and b.snapshot_date = c.snapshot_date"
    + " where b.snapshot_date in (" + ", ".join(f"date '{day}'" for day in VALID_SNAPSHOTS) + ")",
    **_gold("base", []),
    **_gold("full_base", CLICKSTREAM_FEATURES),
    "training": """
        select g.*, g.snapshot_date as loan_open_date, l.snapshot_date as label_obs_date, l.label
        from base_gold g join labels_mob6 l
          on g.Customer_ID = l.Customer_ID
         and strftime(g.snapshot_date, '%Y_%m_%d') = split_part(l.loan_id, '_', 3) || '_'
             || split_part(l.loan_id, '_', 4) || '_' || split_part(l.loan_id, '_', 5)""",
}


def _used(text: str, views: dict[str, str]) -> list[str]:
    """Views that ``text`` reads, directly or through other views, in their order of definition."""
    found: set[str] = set()
    todo = [text]
    while todo:
        words = set(re.findall(r"\w+", todo.pop()))
        new = [name for name in views if name in words and name not in found]
        found.update(new)
        todo += [views[name] for name in new]
    return [name for name in views if name in found]


def duck(body: str) -> str:
    """DuckDB statement: ``body`` after the views it reads."""
    used = _used(body, DUCK)
    if not used:
        return body
    return "with " + ",\n".join(f"{name} as ({DUCK[name]})" for name in used) + "\n" + body


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def raw(spark: SparkSession, sf_dir: str, view: str, held: dict[str, DataFrame] | None = None) -> DataFrame:
    """A raw view over the tables of ``sf_dir``, and over the views of ``held`` as they are there."""
    held = held or {}
    if view in held:
        return held[view]
    text = f"select * from {view}"
    used = _used(text, {name: body for name, body in RAW.items() if name not in held})
    statement = ("with " + ",\n".join(f"{name} as ({RAW[name]})" for name in used) + "\n" + text)
    words = set(re.findall(r"\w+", statement))
    tables = {name: table(spark, sf_dir, name) for name in TABLES if name in words}
    tables |= {name: df for name, df in held.items() if name in words}
    for name in tables:
        statement = re.sub(rf"\b(from|join) {name}\b", rf"\1 {{{name}}}", statement)
    return spark.sql(statement, **tables)


def raws(spark: SparkSession, sf_dir: str, views: list[str]) -> dict[str, DataFrame]:
    """Raw views by name, for jobs that read several of them, or one several times.

    The join of lines and the months of customers under them are computed once and written; each view would else repeat them.
    """
    staging, held = Staging(spark), {}
    for name in ("lines", "customer_months"):
        if any(name in _used(f"select * from {view}", RAW) for view in views):
            held[name] = staging.table(raw(spark, sf_dir, name, held), name)
    return {view: raw(spark, sf_dir, view, held) for view in views}


def span(spark: SparkSession, sf_dir: str, lines: DataFrame | None = None) -> tuple[str, str]:
    """First and last month in which anything was ordered or shipped, by ``lines`` where they are at hand."""
    lines = raw(spark, sf_dir, "lines") if lines is None else lines
    first = F.least(F.min("opened"), F.min("shipped"))
    last = F.greatest(F.max("opened"), F.max("shipped"))
    months = lines.agg(*[F.trunc(day, "month").cast("string").alias(name) for day, name in ((first, "first"), (last, "last"))])
    return tuple(months.first())


def days_for_dates(df: DataFrame) -> DataFrame:
    return df.withColumn("first_missed_day", F.unix_date("first_missed_date")).drop("first_missed_date")


def plain(df: DataFrame) -> DataFrame:
    """32-bit floats widened, which changes no value, so both engines print them alike."""
    return df.select([F.col(c).cast("double").alias(c) if kind == "float" else F.col(c) for c, kind in df.dtypes])

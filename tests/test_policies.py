"""Truth tables of the six masks and three row rules, for every role and for unknown ones."""

from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tierwarden.functions.policies import MASKS, ROW_RULES, Policy, register_mask
from tierwarden.model import MASK_BINDINGS, ROLE_NAMES
from tierwarden.operators.secure import (
    apply_masks, apply_masks_by_role_column, apply_row_policy, declare_free, secure, secure_view,
)
from tierwarden.plans.access import masked_sample

READERS = ROLE_NAMES + ["ACCOUNTADMIN", "NOBODY"]
PRIV = {"DATA_ENGINEER", "DATA_GOVERNANCE_ADMIN", "ACCOUNTADMIN"}


def expected(policy, role, value):
    """What the truth table says, written out branch by branch."""
    def last4(prefix):
        return None if value is None else prefix + value[-4:]
    if policy == "SSN_MASKING_POLICY":
        if role in PRIV:
            return value
        return last4("***-**-") if role in {"HR_MANAGER", "FINANCE_ANALYST"} else "***-**-****"
    if policy == "EMAIL_MASKING_POLICY":
        if role in PRIV | {"HR_MANAGER"}:
            return value
        if role in {"DATA_ANALYST", "SECURITY_AUDITOR"}:
            parts = None if value is None else value.split("@")
            return None if parts is None else "***@" + (parts[1] if len(parts) > 1 else "")
        return "***@***.***"
    if policy == "ACCOUNT_MASKING_POLICY":
        if role in PRIV:
            return value
        return last4("****-****-****-") if role == "FINANCE_ANALYST" else "****-****-****-****"
    if policy == "IP_MASKING_POLICY":
        return value if role in PRIV | {"SECURITY_AUDITOR"} else "***.***.***.***"
    if policy == "AMOUNT_MASKING_POLICY":
        if role in PRIV | {"FINANCE_ANALYST"}:
            return value
        if role == "DATA_ANALYST":
            if value is None:
                return None
            return Decimal(int((value + 50) // 100) * 100).quantize(Decimal("0.01"))
        return Decimal("-1.00")
    return value if role in PRIV | {"FINANCE_ANALYST", "HR_MANAGER"} else Decimal("-1.00")


TEXTS = ["123-45-6789", "a.b@mail.example", "noat", "ab", "", None]
NUMBERS = [Decimal("1250.00"), Decimal("45.50"), Decimal("750.00"), Decimal("89.99"), Decimal("0.00"), None]


@pytest.mark.parametrize("policy", sorted({p for cols in MASK_BINDINGS.values() for p in cols.values()}))
def test_mask_truth_table(spark, policy):
    numeric = policy in {"AMOUNT_MASKING_POLICY", "SALARY_MASKING_POLICY"}
    values = NUMBERS if numeric else TEXTS
    kind = "decimal(12,2)" if numeric else "string"
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    shown = df.select("i", *[MASKS[policy]("v", r).cast(kind).alias(r) for r in READERS]).orderBy("i").collect()
    # The same through a role column.
    pairs = spark.createDataFrame([(i, v, r) for i, v in enumerate(values) for r in READERS],
                                  f"i int, v {kind}, r string")
    by_column = {(x.i, x.r): x.m for x in pairs.select(
        "i", "r", MASKS[policy]("v", F.col("r")).cast(kind).alias("m")).collect()}
    for row, value in zip(shown, values):
        for role in READERS:
            assert row[role] == expected(policy, role, value), (policy, role, value)
            assert by_column[(row["i"], role)] == row[role]


ROW_TABLE = {
    # policy -> (always, conditional, otherwise follows the condition)
    "CUSTOMER_ROW_POLICY": (PRIV | {"HR_MANAGER", "FINANCE_ANALYST"}, {"DATA_ANALYST", "SECURITY_AUDITOR"}, False),
    "EMPLOYEE_ROW_POLICY": (PRIV | {"HR_MANAGER"}, {"DATA_ANALYST", "FINANCE_ANALYST"}, False),
    "TRANSACTION_FRAUD_POLICY": (PRIV | {"FINANCE_ANALYST", "SECURITY_AUDITOR"}, set(), True),
}


@pytest.mark.parametrize("policy", sorted(ROW_TABLE))
def test_row_truth_table(spark, policy):
    always, conditional, rest = ROW_TABLE[policy]
    if policy == "EMPLOYEE_ROW_POLICY":
        df = spark.sql("SELECT * FROM VALUES (1, DATE '2024-06-30'), (2, CAST(NULL AS DATE)) AS t(i, v)")
        passes = {2}
    else:
        df = spark.sql("SELECT * FROM VALUES (1, true), (2, false), (3, CAST(NULL AS BOOLEAN)) AS t(i, v)")
        passes = {1} if policy == "CUSTOMER_ROW_POLICY" else {2}
    everything = {r.i for r in df.collect()}
    for role in READERS:
        seen = {r.i for r in df.where(ROW_RULES[policy](F.col("v"), role)).collect()}
        want = everything if role in always else passes if role in conditional or rest else set()
        assert seen == want, (policy, role)


def test_secured_rows_and_sums(fixture):
    e = fixture.entities
    rows = {t: {r: secure(e[t], t, r).count() for r in ROLE_NAMES}
            for t in ("CUSTOMERS", "EMPLOYEES", "FINANCIAL_TRANSACTIONS")}
    assert rows["CUSTOMERS"] == {"DATA_GOVERNANCE_ADMIN": 10, "DATA_ENGINEER": 10, "HR_MANAGER": 10,
                                 "FINANCE_ANALYST": 10, "DATA_ANALYST": 9, "SECURITY_AUDITOR": 9, "PUBLIC_USER": 0}
    assert rows["EMPLOYEES"] == {"DATA_GOVERNANCE_ADMIN": 10, "DATA_ENGINEER": 10, "HR_MANAGER": 10,
                                 "FINANCE_ANALYST": 9, "DATA_ANALYST": 9, "SECURITY_AUDITOR": 0, "PUBLIC_USER": 0}
    assert rows["FINANCIAL_TRANSACTIONS"] == {
        "DATA_GOVERNANCE_ADMIN": 10, "DATA_ENGINEER": 10, "FINANCE_ANALYST": 10, "SECURITY_AUDITOR": 10,
        "DATA_ANALYST": 9, "HR_MANAGER": 9, "PUBLIC_USER": 9}
    sums = {r: secure(e["FINANCIAL_TRANSACTIONS"], "FINANCIAL_TRANSACTIONS", r)
            .agg(F.sum("transaction_amount")).first()[0] for r in ROLE_NAMES}
    assert sums["DATA_ENGINEER"] == sums["FINANCE_ANALYST"] == Decimal("37254.49")
    assert sums["DATA_ANALYST"] == Decimal("24800.00")
    assert sums["HR_MANAGER"] == sums["PUBLIC_USER"] == Decimal("-9.00")
    assert sums["SECURITY_AUDITOR"] == Decimal("-10.00")


def test_masks_keep_schema_and_rows(fixture):
    for table, df in fixture.entities.items():
        for role in READERS:
            out = apply_masks(df, table, role)
            assert [(f.name, f.dataType) for f in out.schema] == [(f.name, f.dataType) for f in df.schema]
        assert out.count() == df.count()


def test_no_raw_value_leaks(fixture):
    e = fixture.entities["CUSTOMERS"]
    raw = {r.ssn for r in e.select("ssn").collect()}
    for role in ("DATA_ANALYST", "SECURITY_AUDITOR", "PUBLIC_USER", "NOBODY", "HR_MANAGER", "FINANCE_ANALYST"):
        assert not raw & {r.ssn for r in apply_masks(e, "customers", role).select("ssn").collect()}


def test_filter_on_secured_frame_sees_masked_values(fixture):
    e = fixture.entities["CUSTOMERS"]
    raw = e.first()["ssn"]
    assert secure(e, "CUSTOMERS", "DATA_ANALYST").where(F.col("ssn") == raw).count() == 0
    assert secure(e, "CUSTOMERS", "DATA_ENGINEER").where(F.col("ssn") == raw).count() == 1


def test_fully_masked_column_is_not_read(spark, fixture, tmp_path):
    path = str(tmp_path / "customers")
    fixture.entities["CUSTOMERS"].write.parquet(path)
    df = spark.read.parquet(path)
    plan = secure(df, "CUSTOMERS", "DATA_ANALYST").select("customer_id", "ssn") \
        ._jdf.queryExecution().executedPlan().toString()
    assert "ssn" not in plan.split("ReadSchema")[1]
    assert "EqualTo(is_active,true)" in plan or "is_active" in plan.split("PushedFilters")[1]
    nobody = secure(df, "CUSTOMERS", "PUBLIC_USER")._jdf.queryExecution().executedPlan().toString()
    assert "FileScan" not in nobody


def test_role_column_and_view_and_custom_mask(spark, fixture):
    e = fixture.entities["EMPLOYEES"].withColumn("reader", F.when(F.col("employee_id") == 5001, "HR_MANAGER")
                                                 .otherwise("PUBLIC_USER"))
    rows = {r.employee_id: r for r in apply_masks_by_role_column(e, "EMPLOYEES", "reader").collect()}
    assert rows[5001].email == "e1@company.example" and rows[5002].email == "***@***.***"
    assert secure_view(fixture.entities["EMPLOYEES"], "EMPLOYEES", "HR_MANAGER", "hr_employees").count() == 10
    assert spark.sql("SELECT count(*) FROM hr_employees WHERE salary = -1").first()[0] == 0
    register_mask("initial_only", Policy(((("HR_MANAGER",), lambda c: c),), lambda c: F.left(c, F.lit(1))))
    out = apply_masks(fixture.entities["EMPLOYEES"], "EMPLOYEES", "DATA_ANALYST",
                      {"EMPLOYEES": {"LAST_NAME": "initial_only"}})
    assert {r.last_name for r in out.select("last_name").collect()} == {"L", "O"}


def test_masking_in_action_sample(fixture):
    first = masked_sample(fixture.entities["EMPLOYEES"], "EMPLOYEES", "DATA_ANALYST",
                          ["employee_id", "email", "ssn", "salary"], "employee_id").collect()
    assert len(first) == secure(fixture.entities["EMPLOYEES"], "EMPLOYEES", "DATA_ANALYST").count()
    assert {(r.email, r.ssn, r.salary) for r in first} == {("***@company.example", "***-**-****", Decimal("-1.00"))}


def test_table_without_row_rule_is_unfiltered(fixture):
    df = fixture.entities["PRODUCTS"]
    assert apply_row_policy(df, "PRODUCTS", "PUBLIC_USER").count() == 10


def test_reads_fail_closed(spark, fixture):
    customers = fixture.entities["CUSTOMERS"]
    for read in (secure, apply_masks, apply_row_policy):
        with pytest.raises(ValueError):
            read(customers, "CUSTOMER", "PUBLIC_USER")
    with pytest.raises(ValueError):
        apply_masks(customers.drop("ssn"), "CUSTOMERS", "DATA_ENGINEER")
    with pytest.raises(ValueError):
        apply_row_policy(customers.drop("is_active"), "CUSTOMERS", "DATA_ENGINEER")
    assert secure(customers, "CUSTOMERS", "PUBLIC_USER").count() == 0
    declare_free("weather")
    assert secure(spark.range(3), "WEATHER", "PUBLIC_USER").count() == 3


def test_largest_amounts_are_masked_without_an_error(spark):
    rows = [(Decimal(x),) for x in ("9999999949.99", "9999999950.00", "9999999999.99", "-9999999999.99", "149.99")]
    df = spark.createDataFrame(rows, "transaction_amount decimal(12,2)")
    bound = {"FINANCIAL_TRANSACTIONS": {"TRANSACTION_AMOUNT": "AMOUNT_MASKING_POLICY"}}
    seen = [r[0] for r in apply_masks(df, "FINANCIAL_TRANSACTIONS", "DATA_ANALYST", bound).collect()]
    assert seen == [Decimal("9999999900.00"), None, None, None, Decimal("100.00")]
    assert [r[0] for r in apply_masks(df, "FINANCIAL_TRANSACTIONS", "DATA_ENGINEER", bound).collect()] == [r[0] for r in rows]

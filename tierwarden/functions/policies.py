"""Masking and row-access policies as Column expressions.

A policy is data: an ordered list of (roles, expression) branches plus a
fallback.  The role may be a plain string (one reader; the optimizer folds the
branch away, so a fully masked column is not even read) or a Column (every row
carries its own reader).  No Python UDF is involved.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from typing import Union

from pyspark.sql import Column
from pyspark.sql import functions as F

from tierwarden.model import STEWARDS

Role = Union[str, Column]
Branch = tuple[tuple[str, ...], Callable[[Column], Column]]


@dataclass(frozen=True)
class Policy:
    """Branches tried in order by role; ``otherwise`` covers every other role."""

    branches: tuple[Branch, ...]
    otherwise: Callable[[Column], Column]

    def __call__(self, value: Column | str, role: Role) -> Column:
        col = F.col(value) if isinstance(value, str) else value
        reader = F.lit(role) if isinstance(role, str) else role
        picked = None
        for roles, build in self.branches:
            test = reader.isin(*roles)
            picked = F.when(test, build(col)) if picked is None else picked.when(test, build(col))
        return self.otherwise(col) if picked is None else picked.otherwise(self.otherwise(col))


def _clear(col: Column) -> Column:
    return col


def _text(mask: str) -> Callable[[Column], Column]:
    return lambda col: F.lit(mask)


def _last4(prefix: str) -> Callable[[Column], Column]:
    return lambda col: F.concat(F.lit(prefix), F.right(col, F.lit(4)))


def _sentinel(col: Column) -> Column:
    return F.lit(-1)


MASKS: dict[str, Policy] = {}
ROW_RULES: dict[str, Policy] = {}


def register_mask(name: str, policy: Policy) -> None:
    MASKS[name.upper()] = policy


def register_row_rule(name: str, policy: Policy) -> None:
    ROW_RULES[name.upper()] = policy


# Who sees what, and the mask texts.
register_mask("SSN_MASKING_POLICY", Policy(
    ((STEWARDS, _clear), (("HR_MANAGER", "FINANCE_ANALYST"), _last4("***-**-"))),
    _text("***-**-****")))
register_mask("EMAIL_MASKING_POLICY", Policy(
    ((STEWARDS + ("HR_MANAGER",), _clear),
     (("DATA_ANALYST", "SECURITY_AUDITOR"),
      lambda col: F.concat(F.lit("***@"), F.split_part(col, F.lit("@"), F.lit(2))))),
    _text("***@***.***")))
register_mask("AMOUNT_MASKING_POLICY", Policy(
    ((STEWARDS + ("FINANCE_ANALYST",), _clear),
     (("DATA_ANALYST",), lambda col: F.round(col, -2))),
    _sentinel))
register_mask("ACCOUNT_MASKING_POLICY", Policy(
    ((STEWARDS, _clear), (("FINANCE_ANALYST",), _last4("****-****-****-"))),
    _text("****-****-****-****")))
register_mask("IP_MASKING_POLICY", Policy(
    ((STEWARDS + ("SECURITY_AUDITOR",), _clear),), _text("***.***.***.***")))
register_mask("SALARY_MASKING_POLICY", Policy(
    ((STEWARDS + ("FINANCE_ANALYST", "HR_MANAGER"), _clear),), _sentinel))

register_row_rule("CUSTOMER_ROW_POLICY", Policy(
    ((STEWARDS + ("HR_MANAGER", "FINANCE_ANALYST"), lambda col: F.lit(True)),
     (("DATA_ANALYST", "SECURITY_AUDITOR"), _clear)),
    lambda col: F.lit(False)))
register_row_rule("EMPLOYEE_ROW_POLICY", Policy(
    ((STEWARDS + ("HR_MANAGER",), lambda col: F.lit(True)),
     (("DATA_ANALYST", "FINANCE_ANALYST"), lambda col: col.isNull())),
    lambda col: F.lit(False)))
register_row_rule("TRANSACTION_FRAUD_POLICY", Policy(
    ((STEWARDS + ("FINANCE_ANALYST", "SECURITY_AUDITOR"), lambda col: F.lit(True)),),
    lambda col: ~col))


def mask_ssn(col: Column | str, role: Role) -> Column:
    return MASKS["SSN_MASKING_POLICY"](col, role)


def mask_email(col: Column | str, role: Role) -> Column:
    return MASKS["EMAIL_MASKING_POLICY"](col, role)


def mask_amount(col: Column | str, role: Role) -> Column:
    return MASKS["AMOUNT_MASKING_POLICY"](col, role)


def mask_account(col: Column | str, role: Role) -> Column:
    return MASKS["ACCOUNT_MASKING_POLICY"](col, role)


def mask_ip(col: Column | str, role: Role) -> Column:
    return MASKS["IP_MASKING_POLICY"](col, role)


def mask_salary(col: Column | str, role: Role) -> Column:
    return MASKS["SALARY_MASKING_POLICY"](col, role)


def customer_row_predicate(role: Role, is_active: Column | str = "is_active") -> Column:
    return ROW_RULES["CUSTOMER_ROW_POLICY"](is_active, role)


def employee_row_predicate(role: Role, termination_date: Column | str = "termination_date") -> Column:
    return ROW_RULES["EMPLOYEE_ROW_POLICY"](termination_date, role)


def transaction_fraud_predicate(role: Role, fraud_flag: Column | str = "fraud_flag") -> Column:
    return ROW_RULES["TRANSACTION_FRAUD_POLICY"](fraud_flag, role)

"""Column masks. The roles are known when the plan is built, so a hidden column becomes a constant and is never read."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from wardflow.functions.text import last_chars
from wardflow.governance.roles import ADMIN, CLINICIAN

Roles = frozenset[str]


def mask_ssn(col: Column, roles: Roles) -> Column:
    if ADMIN in roles:
        return col
    if CLINICIAN in roles:
        return F.concat(F.lit("***-**-"), last_chars(col, 4))
    return F.lit("***-**-****")


def mask_pii(col: Column, roles: Roles) -> Column:
    return col if {ADMIN, CLINICIAN} & roles else F.lit("***MASKED***")


def mask_dob(col: Column, roles: Roles) -> Column:
    return col if {ADMIN, CLINICIAN} & roles else F.lit(None).cast("date")


@dataclass(frozen=True)
class MaskPolicy:
    """A mask for columns of one type; it applies to no other type."""

    name: str
    data_type: str
    apply: Callable[[Column, Roles], Column]
    comment: str = ""


def closed(policy: MaskPolicy, data_type: str) -> MaskPolicy:
    """The mask for a column of another type: the value for those whom the mask shows it unchanged, NULL for others."""

    def apply(col: Column, roles: Roles) -> Column:
        return col if policy.apply(col, roles) is col else F.lit(None).cast(data_type)

    return MaskPolicy(f"{policy.name}_CLOSED", data_type, apply, f"{policy.comment}; NULL where the type differs")


MASK_SSN = MaskPolicy("MASK_SSN", "string", mask_ssn, "full for ADMIN, last four for CLINICIAN, hidden for others")
MASK_PII_STRING = MaskPolicy("MASK_PII_STRING", "string", mask_pii, "visible to ADMIN and CLINICIAN, hidden for others")
MASK_DOB = MaskPolicy("MASK_DOB", "date", mask_dob, "visible to ADMIN and CLINICIAN, NULL for others")

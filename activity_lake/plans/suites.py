"""The rule suites of the three inputs.

Severities, bounds and sets are fixed values.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from activity_lake.functions.business import COMMUTE_LIMIT_KM, CONTRACT_TYPES
from activity_lake.operators.quality import (
    FAILED, WARNING, Between, DistinctInSet, InSet, NotNull, Rule, Unique,
)
from activity_lake.operators.reporting import official_sports


def hr_suite() -> list[Rule]:
    by_name = {"reference": "last_name"}
    return [
        NotNull("id", "id is given", WARNING, keep_row=False, **by_name),
        Unique("id", "id is unique", FAILED, **by_name),
        NotNull("first_name", "first name is given", WARNING),
        NotNull("last_name", "last name is given", FAILED),
        InSet("transport_mode", "transport mode is known", FAILED, values=tuple(COMMUTE_LIMIT_KM)),
        NotNull("distance_kms", "distance is given", WARNING, keep_row=False),
        InSet("employement_contract", "contract type is known", WARNING, values=tuple(CONTRACT_TYPES)),
        Between("margin_kms", "distance fits the transport mode", WARNING, keep_row=False, low=0),
        Between("age", "age is 16 to 80", WARNING, low=16, high=80),
        Between("seniority_years", "seniority is 0 to 7", WARNING, low=0, high=7),
        Between("salary", "salary is 15000 to 150000", WARNING, keep_row=False,
                low=15000, high=150000),
    ]


def sport_suite(sports: DataFrame) -> list[Rule]:
    return [
        NotNull("id", "id is given", WARNING, keep_row=False),
        Unique("id", "id is unique", FAILED),
        DistinctInSet("sport_type", "sport is an official one", WARNING,
                      known=official_sports(sports), known_column="sport"),
    ]


def activity_suite(employees: DataFrame) -> list[Rule]:
    def required(column: str, what: str) -> Rule:
        return NotNull(column, f"{what} is given", WARNING, keep_row=False)

    return [
        required("id", "id"),
        Unique("id", "id is unique", FAILED),
        DistinctInSet("employee_id", "employee exists", WARNING, keep_row=False, known=employees),
        required("sport", "sport"),
        required("duration_sec", "duration"),
        required("begin_date", "begin date"),
    ]

"""Every row-local rule kind against hand-made rows: null, blank, NaN and boundary values."""

import math

import pytest

from plumbline.functions.dates import as_of_sql
from plumbline.functions.predicates import (
    AllOf, AnyOf, AtLeast, Between, DateOrder, Expression, FreshWithin, Implies, InSet, IsOther, IsValue, Matches,
    NotBelow, NotBlank, NotEqual, NotFuture, NotNull, NotOverdue, NotPrefix, NotSentinel, PositiveNumber, RequiredIf,
    ValidDate,
)

AS_OF = as_of_sql("2025-06-30")


def failures(spark, check, rows, schema):
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], f"i INT, {schema}")
    found = {r["i"] for r in df.where(check.failed(AS_OF)).collect()}
    return [i in found for i in range(len(rows))]


TEXT = "a STRING"
PAIR = "a STRING, b STRING"
NBSP = "\u00a0"

CASES = [
    (NotNull("a"), TEXT, [(None, True), ("", False), ("x", False)]),
    (NotBlank("a"), TEXT, [(None, True), ("", True), (" \t\n", True), (NBSP, True), ("\u3000", True), (" x", False),
                           ("é", False), (NBSP + "x", False)]),
    (NotSentinel("a", ("Unknown Counterparty",)), TEXT,
     [(None, True), ("Unknown Counterparty", True), (" Unknown Counterparty\t", True),
      ("Unknown Counterparty Ltd", False), ("unknown counterparty", False)]),
    (InSet("a", ("US", "GB")), TEXT, [(None, True), ("US", False), (" US", True), ("us", True)]),
    (InSet("a", ("US", "GB"), strip=True), TEXT, [(None, True), (" US\n", False), (NBSP + "GB", False), ("", True)]),
    (InSet("a", ("US",), null_fails=False), TEXT, [(None, False), ("XX", True)]),
    (Between("a", 0, 1), TEXT, [(None, True), ("0", False), ("1", False), ("1.01", True), ("-0.1", True),
                                ("high", True), ("NaN", True), ("0.5f", True), (" 0.5 ", False)]),
    (Between("a", 0, 1, null_fails=False), "a DOUBLE", [(None, False), (math.nan, False), (2.0, True), (0.0, False)]),
    (PositiveNumber("a"), TEXT, [(None, True), ("n.a.", True), ("0", True), ("-1", True), ("0.01", False), ("NaN", True),
                                 ("12d", True), ("1e3", False)]),
    (NotBelow("a", 0.7), TEXT, [(None, False), ("0.69", True), ("0.70", False), ("-0.1", False), ("x", False)]),
    (NotBelow("a", 0.7, low=None, null_fails=True), "a DOUBLE", [(None, True), (-0.1, True), (0.7, False), (math.nan, True)]),
    (ValidDate("a"), TEXT, [(None, True), ("2024-02-30", True), ("2024-02-29", False), ("pending", True)]),
    (DateOrder("a", "b"), PAIR, [(("2024-01-02", "2024-01-01"), True), (("2024-01-01", "2024-01-01"), False),
                                 ((None, "2024-01-01"), False), (("x", "2024-01-01"), False)]),
    (NotFuture("a"), TEXT, [(None, False), ("2025-06-30", False), ("2025-07-01", True)]),
    (NotOverdue("a"), TEXT, [(None, False), ("2025-06-30", False), ("2025-06-29", True)]),
    (FreshWithin("a"), TEXT, [(None, False), ("2024-06-30", False), ("2024-06-29", True)]),
    (FreshWithin("a", inclusive=True), TEXT, [("2024-06-30", True), ("2024-07-01", False), (None, False)]),
    (FreshWithin("a", only=("b", ("Active",))), PAIR,
     [(("2020-01-01", "Active"), True), (("2020-01-01", "Merged"), False), (("2020-01-01", None), False)]),
    (RequiredIf("a", "Listed", "b"), PAIR, [(("Listed", None), True), (("Listed", ""), False), ((None, None), False)]),
    (Implies("a", "High", "b", "Approved"), PAIR,
     [(("High", None), True), (("High", "Approved"), False), ((" High ", " Approved "), False), (("Low", None), False),
      (("High", "Not Approved"), True)]),
    (Implies("a", "High", "b", "Approved", null_as_blank=False), PAIR,
     [(("High", None), False), (("High", "Pending"), True), (("Low", "Pending"), False)]),
    (Matches("a", "^[A-Z]{2}[A-Z0-9]{10}$"), TEXT,
     [(None, True), ("", True), ("US0378331005", False), (" US0378331005 ", False), ("us0378331005", True), ("US037833100", True)]),
    (NotPrefix("a", "ISS-ORPHAN"), TEXT, [(None, False), ("", False), (" ISS-ORPHAN-1", True), ("X ISS-ORPHAN", False)]),
    (NotPrefix("a", "ISS-ORPHAN", blank_fails=True), TEXT, [(None, True), (" ", True), ("ISS-1", False)]),
    (NotEqual("a", "b"), PAIR, [(("x", "x"), True), ((None, None), False), (("x", "y"), False)]),
    (AllOf((AtLeast("a", 10_000_000), AnyOf((IsValue("b", "High"), IsOther("b", "Low"))))), PAIR,
     [(("10000000", "High"), True), (("9999999.99", "High"), False), (("10000000", None), False),
      (("10000000", "Low"), False), (("NaN", "High"), False)]),
    (Expression("length(a) > 3"), TEXT, [(None, False), ("abcd", True)]),
]


@pytest.mark.parametrize("check,schema,cases", CASES, ids=[type(c[0]).__name__ + str(i) for i, c in enumerate(CASES)])
def test_kind(spark, check, schema, cases):
    rows = [c[0] if isinstance(c[0], tuple) else (c[0],) for c in cases]
    assert failures(spark, check, rows, schema) == [c[1] for c in cases]

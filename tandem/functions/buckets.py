"""Range buckets ("ladders"): ordered rules, first match wins.

Edges are kept exactly as the reports define them, including the gaps they
leave (a slack of 10.5 minutes, or exactly 26 / 22 minutes, falls to the
default label).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

NA = " N/A"

# Report labels and edges.  A rule is (op, bounds, label) with op
# "lt" (x < a), "between" (a <= x <= b, both ends included) or "gt" (x > a).
SLACK_RULES = [
    ("lt", (0,), "Early"),
    ("between", (0, 10), "0 to 10 Mins"),
    ("between", (11, 15), "11 to 15 Mins"),
    ("between", (16, 20), "16 to 20 Mins"),
    ("between", (21, 25), "21 to 25 Mins"),
    ("between", (26, 30), "26 to 30 Mins"),
    ("between", (30, 40), "30 to 40 Mins"),
    ("gt", (40,), ">40 Mins"),
]
CTOD_RULES = [
    ("between", (0, 5), "0 to 5 Mins"),
    ("between", (6, 8), "6 to 8 Mins"),
    ("between", (9, 11), "9 to 11 Mins"),
    ("between", (12, 15), "12 to 15 Mins"),
    ("between", (16, 20), "16 to 20 Mins"),
    ("between", (21, 25), "21 to 25 Mins"),
    ("gt", (26,), "> 25 Mins"),
]
KM_RULES = [
    ("between", (0, 2), "0 to 2 KMs"),
    ("between", (3, 5), "3 to 5 KMs"),
    ("between", (6, 8), "6 to 8 KMs"),
    ("between", (9, 11), "9 to 11 KMs"),
    ("between", (12, 14), "12 to 14 KMs"),
    ("between", (15, 17), "15 to 17 KMs"),
    ("between", (18, 20), "18 to 20 KMs"),
    ("gt", (20,), "21+ KMs"),
]
DRIVE_RULES = [
    ("between", (0, 2), "0 to 2 Mins"),
    ("between", (3, 5), "3 to 5 Mins"),
    ("between", (6, 8), "6 to 8 Mins"),
    ("between", (9, 11), "9 to 11 Mins"),
    ("between", (12, 14), "12 to 14 Mins"),
    ("between", (15, 17), "15 to 17 Mins"),
    ("between", (18, 20), "18 to 20 Mins"),
    ("gt", (20,), "21+ Mins"),
]
PTOV_RULES = [
    ("between", (0, 2), "0 to 2 Mins"),
    ("between", (3, 5), "3 to 5 Mins"),
    ("between", (6, 8), "6 to 8 Mins"),
    ("between", (9, 11), "9 to 11 Mins"),
    ("between", (12, 14), "12 to 14 Mins"),
    ("between", (15, 17), "15 to 17 Mins"),
    ("between", (18, 21), "18 to 21 Mins"),
    ("gt", (22,), "> 21 Mins"),
]
DAYPART_RULES = [
    ("between", (7, 10), "Breakfast"),
    ("between", (11, 15), "Lunch"),
    ("between", (16, 19), "Dinner"),
    ("between", (20, 23), "After-Dinner"),
    ("between", (0, 6), "Overnight"),
]
ON_TIME_RANGE = (0, 10)
CTOD_TEXT_CAP = 30  # whole minutes >= this read "+30"; below zero reads "0"


def _test(x: Column, op: str, bounds: Sequence) -> Column:
    if op == "lt":
        return x < F.lit(bounds[0])
    if op == "gt":
        return x > F.lit(bounds[0])
    if op == "between":
        return x.between(F.lit(bounds[0]), F.lit(bounds[1]))
    raise ValueError(op)


def _sql_test(x: str, op: str, bounds: Sequence) -> str:
    if op == "lt":
        return f"{x} < {bounds[0]}"
    if op == "gt":
        return f"{x} > {bounds[0]}"
    if op == "between":
        return f"{x} BETWEEN {bounds[0]} AND {bounds[1]}"
    raise ValueError(op)


def _sql_label(label: str) -> str:
    return "'" + label.replace("'", "''") + "'"


def ladder(x, rules: Sequence, default: str | None = None, guard=None) -> Column:
    """Chained CASE over ``rules``; ``guard`` must also hold for every rule.

    ``x`` (and ``guard``) may be Columns or SQL expression text; given text,
    the whole CASE is built as one expression on the JVM side (one call from
    Python instead of several per rule).  With ``default=None`` an unmatched
    (or null) input gives null, as a CASE without ELSE does.
    """
    if isinstance(x, str) and (guard is None or isinstance(guard, str)):
        g = f" AND ({guard})" if guard is not None else ""
        whens = " ".join(f"WHEN ({_sql_test(x, op, b)}){g} THEN {_sql_label(lab)}" for op, b, lab in rules)
        tail = f" ELSE {_sql_label(default)}" if default is not None else ""
        return F.expr(f"CASE {whens}{tail} END")
    if isinstance(x, str):
        x = F.expr(x)
    if isinstance(guard, str):
        guard = F.expr(guard)
    out = None
    for op, bounds, label in rules:
        cond = _test(x, op, bounds)
        if guard is not None:
            cond = cond & guard
        out = F.when(cond, F.lit(label)) if out is None else out.when(cond, F.lit(label))
    return out if default is None else out.otherwise(F.lit(default))


# Each bucket function takes a Column or a column name; given a name the
# ladder is built as one SQL CASE expression.

def _q(name: str) -> str:
    return "`" + name + "`"


def whole_minutes(seconds: Column) -> Column:
    return F.floor(seconds / F.lit(60.0))


def slack_bin(slack_min) -> Column:
    if isinstance(slack_min, str):
        return ladder(f"CAST({_q(slack_min)} AS DOUBLE)", SLACK_RULES, NA)
    return ladder(slack_min, SLACK_RULES, NA)


def on_time_flag(slack_min) -> Column:
    lo, hi = ON_TIME_RANGE
    if isinstance(slack_min, str):
        return F.expr(f"CASE WHEN {_q(slack_min)} BETWEEN {lo} AND {hi} THEN 1 ELSE 0 END")
    return F.when(slack_min.between(F.lit(lo), F.lit(hi)), F.lit(1)).otherwise(F.lit(0))


def ctod_bin(ctod_sec) -> Column:
    if isinstance(ctod_sec, str):
        return ladder(f"FLOOR({_q(ctod_sec)} / 60.0D)", CTOD_RULES, NA)
    return ladder(whole_minutes(ctod_sec), CTOD_RULES, NA)


def km_bin(meters) -> Column:
    if isinstance(meters, str):
        return ladder(f"FLOOR({_q(meters)} / 1000.0D)", KM_RULES)
    return ladder(F.floor(meters / F.lit(1000.0)), KM_RULES)


def drive_bin(minutes) -> Column:
    if isinstance(minutes, str):
        return ladder(f"FLOOR({_q(minutes)})", DRIVE_RULES)
    return ladder(F.floor(minutes), DRIVE_RULES)


def ptov_bin(ptov_sec, is_asap) -> Column:
    if isinstance(ptov_sec, str) and isinstance(is_asap, str):
        return ladder(f"FLOOR({_q(ptov_sec)} / 60.0D)", PTOV_RULES, NA, guard=f"{_q(is_asap)} = 1")
    return ladder(whole_minutes(ptov_sec), PTOV_RULES, NA, guard=(is_asap == F.lit(1)))


def daypart(ts) -> Column:
    if isinstance(ts, str):
        return ladder(f"HOUR({_q(ts)})", DAYPART_RULES)
    return ladder(F.hour(ts), DAYPART_RULES)


def ctod_text(ctod_sec: Column) -> Column:
    m = whole_minutes(ctod_sec)
    return (F.when(m >= F.lit(CTOD_TEXT_CAP), F.lit(f"+{CTOD_TEXT_CAP}"))
             .when(m < F.lit(0), F.lit("0"))
             .otherwise(m.cast("string")))

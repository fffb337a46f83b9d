"""Ordered rule lists as data, folded into one CASE expression each."""

from typing import NamedTuple

from pyspark.sql import functions as F

from cutline import fixed_values as fixed


class Rule(NamedTuple):
    label: str
    test: str  # regex | prefix | suffix | one_of
    value: object


def _holds(column, rule):
    if rule.test == "regex":
        return column.rlike(rule.value)
    if rule.test == "prefix":
        return column.startswith(rule.value)
    if rule.test == "suffix":
        return column.endswith(rule.value)
    if rule.test == "one_of":
        return column.isin(*rule.value)
    raise ValueError(f"unknown rule test {rule.test!r}")


def first_match(column, rules, otherwise):
    """Label of the first rule that holds; NULL input holds for no rule and yields `otherwise`."""
    head, *tail = rules
    case = F.when(_holds(column, head), F.lit(head.label))
    for rule in tail:
        case = case.when(_holds(column, rule), F.lit(rule.label))
    return case.otherwise(otherwise)


CATEGORY_RULES = [Rule(label, "regex", pattern) for label, pattern in fixed.CATEGORY_PATTERNS]
CATEGORY_RULES_V1 = [Rule(label, "regex", pattern) for label, pattern in fixed.CATEGORY_PATTERNS_V1]

SEAT_GENDER_RULES = [Rule(*row) for row in fixed.SEAT_GENDERS]
SEAT_GENDER_RULES_V1 = [Rule(*row) for row in fixed.SEAT_GENDERS_V1]
SEAT_POOL_RULES = [Rule(*row) for row in fixed.SEAT_POOLS]


def leading_category(column):
    """The category word a text begins with, '' if none.

    One anchored alternation, tried in list order, in place of one regex per word.
    """
    words = "|".join(fixed.CATEGORY_LEADING_WORDS)
    return F.upper(F.regexp_extract(column, f"(?i)^({words})", 1))


def clean_category(column, leading):
    """Standard name of a category; `leading` is its `leading_category`, computed in an earlier projection."""
    return F.when(leading != "", leading).otherwise(first_match(column, CATEGORY_RULES, otherwise=column))


def clean_category_v1(column):
    return first_match(
        column, CATEGORY_RULES_V1, otherwise=F.regexp_replace(column, fixed.CATEGORY_LEFTOVER_V1, "")
    )


def seat_gender(column):
    return first_match(column, SEAT_GENDER_RULES, otherwise=F.lit("M"))


def seat_gender_v1(column):
    return first_match(column, SEAT_GENDER_RULES_V1, otherwise=F.lit("M"))


def seat_pool(column):
    return first_match(column, SEAT_POOL_RULES, otherwise=F.lit("Other"))


def round_number(column):
    """Position of the round label, 1 to 4; NULL for any other label."""
    labels = F.array(*[F.lit(label) for label in fixed.ROUND_LABELS])
    return F.nullif(F.array_position(labels, column), F.lit(0).cast("bigint")).cast("int")


def likely_round(cutoffs, score):
    """First round whose cutoff the score reaches; a NULL cutoff never matches."""
    rounds = list(zip(cutoffs, fixed.ROUND_LABELS))
    case = F.when(F.col(rounds[0][0]) <= score, rounds[0][1])
    for cutoff, label in rounds[1:]:
        case = case.when(F.col(cutoff) <= score, label)
    return case.otherwise(fixed.UNREACHABLE_ROUND)

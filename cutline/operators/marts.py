"""Silver to Gold: cutoff marts.

Every mart rolls up from `seat_facts`, one row per finest key and round. That first aggregate is the
only one that reads Silver: three plain measures, reduced in each task before the shuffle, so a hot
key costs one row per task. The spread over round columns and the set of pools are computed on the
reduced facts, whose number grows with the keys and not with the rows.
"""

from pyspark.sql import functions as F

from cutline import fixed_values as fixed

ROUNDS = tuple(range(1, len(fixed.ROUND_LABELS) + 1))
FACT_KEYS = (*fixed.MAIN_MART_KEYS, "seat_pool")


def seat_facts(silver, keys=FACT_KEYS):
    """Lowest score, highest score and number of seats per key and round."""
    return silver.groupBy(*keys, "cap_round_num").agg(
        F.min("mhtcet_score").alias("low"),
        F.max("mhtcet_score").alias("high"),
        F.count(F.lit(1)).alias("seats"),
    )


def _in_round(number, value, included=None):
    condition = F.col("cap_round_num") == number
    return F.when(condition if included is None else condition & included, F.col(value))


def _cutoffs(included=None):
    return [F.round(F.min(_in_round(n, "low", included)), 4).alias(f"cap{n}_cutoff") for n in ROUNDS]


def _tops(rounds=ROUNDS, included=None):
    return [F.round(F.max(_in_round(n, "high", included)), 4).alias(f"cap{n}_max") for n in rounds]


def _total(included=None):
    seats = F.col("seats") if included is None else F.when(included, F.col("seats"))
    return F.sum(seats).alias("total_seats_filled")


def _seats(included=None):
    return [F.coalesce(F.sum(_in_round(n, "seats", included)), F.lit(0)).alias(f"cap{n}_seats") for n in ROUNDS]


def _filled_in_last_round(mart):
    return mart.filter(F.col(f"cap{ROUNDS[-1]}_cutoff").isNotNull())


def main_mart_from_facts(facts, excluded_pools=fixed.POOLS_OUTSIDE_MAIN_MART):
    """The lookup mart, without the pools that have other admission rules.

    The exclusion is a condition on the measures and not a filter: a filter on a key is pushed through
    the aggregates and evaluates the whole cleaning expression a second time below the joins. Groups
    that hold excluded pools only have no last-round cutoff and drop out at the end.
    """
    included = ~F.col("seat_pool").isin(*excluded_pools)
    mart = facts.groupBy(*fixed.MAIN_MART_KEYS).agg(
        *_cutoffs(included), *_tops(included=included), _total(included), *_seats(included),
        F.sort_array(F.collect_set(F.when(included, F.col("seat_pool")))).alias("seat_pools_available"),
    )
    return _filled_in_last_round(mart)


def pool_mart_from_facts(facts):
    return _filled_in_last_round(facts.groupBy(*fixed.POOL_MART_KEYS).agg(*_cutoffs(), _total()))


def main_mart(silver, excluded_pools=fixed.POOLS_OUTSIDE_MAIN_MART):
    return main_mart_from_facts(seat_facts(silver), excluded_pools)


def pool_mart(silver):
    return pool_mart_from_facts(seat_facts(silver, fixed.POOL_MART_KEYS))


def v1_mart(silver_v1):
    """The superseded mart: five keys, tops of the first and last round only, no pool exclusion."""
    mart = seat_facts(silver_v1, fixed.V1_MART_KEYS).groupBy(*fixed.V1_MART_KEYS).agg(
        *_cutoffs(), *_tops((ROUNDS[0], ROUNDS[-1])), _total(), *_seats()
    )
    return _filled_in_last_round(mart)

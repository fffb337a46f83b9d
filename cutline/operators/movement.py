"""Movement of candidates between rounds.

A candidate's rows are reduced to one seat per round before the window, in each task first, so a candidate with very many
rows costs the window no more than one row per round. The rows carry the candidate's id; publish them through
`privacy.mask_columns`, or publish `move_totals`, which holds no personal column.
"""

from pyspark.sql import Window
from pyspark.sql import functions as F

SEAT = ("institute_code", "branch_name")
FIRST, SAME, BETTER, WORSE, LEVEL = "first", "same", "better", "worse", "level"


def seat_standing(facts):
    """The lowest score that any round took, per institute and branch: how sought-after a seat is."""
    return facts.groupBy(*SEAT).agg(F.min("low").alias("standing"))


def seats_by_round(silver):
    """One seat per candidate and round: that of the highest score, of equals the last by institute and branch."""
    seat = F.max(F.struct("mhtcet_score", *SEAT)).alias("seat")
    held = silver.filter(F.col("cap_round_num").isNotNull()).groupBy("application_id", "cap_round_num").agg(seat)
    return held.select("application_id", "cap_round_num", *[F.col(f"seat.{name}").alias(name) for name in SEAT])


def candidate_moves(silver, facts):
    """Per candidate and round: the seat, the round before it in which the candidate held one, and what changed.

    `same` is the same institute and branch, `better` and `worse` a seat with a higher or lower standing, `level` another seat
    of the same standing. `left` marks the last seat of a candidate who is in no later round, though there is one.
    """
    held = seats_by_round(silver)
    standing = seat_standing(facts)
    ranked = held.join(
        standing.select(*[F.col(name).alias(f"_{name}") for name in SEAT], "standing"),
        F.col("institute_code").eqNullSafe(F.col("_institute_code")) & F.col("branch_name").eqNullSafe(F.col("_branch_name")),
    ).drop("_institute_code", "_branch_name")
    rounds = Window.partitionBy("application_id").orderBy("cap_round_num")
    before = F.lag(F.struct("cap_round_num", *SEAT, "standing")).over(rounds)
    last_round = facts.agg(F.max("cap_round_num")).scalar()
    moved = ranked.withColumns({"before": before, "later": F.lead("cap_round_num").over(rounds)})
    same = F.lit(True)
    for name in SEAT:
        same = same & F.col(name).eqNullSafe(F.col(f"before.{name}"))
    change = (
        F.when(F.col("before").isNull(), FIRST).when(same, SAME)
        .when(F.col("standing") > F.col("before.standing"), BETTER)
        .when(F.col("standing") < F.col("before.standing"), WORSE).otherwise(LEVEL)
    )
    return moved.select(
        "application_id", "cap_round_num", *SEAT, F.col("before.cap_round_num").alias("previous_round"),
        change.alias("change"), (F.col("later").isNull() & (F.col("cap_round_num") < last_round)).alias("left"),
    )


def move_totals(moves):
    """Candidates per round, previous round and change, and how many of them left."""
    return moves.groupBy("cap_round_num", "previous_round", "change").agg(
        F.count(F.lit(1)).alias("candidates"), F.count_if("left").alias("left"))

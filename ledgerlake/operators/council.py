"""Decisions by quorum, threshold and veto, in integer arithmetic."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def decide(members: DataFrame, by: list[str], quorum_percent: int, approval_percent: int) -> DataFrame:
    """The decision of each council.

    ``members`` has vote ('yes', 'no', 'abstain', null for none) and guardian. All
    cast votes count for the quorum, only yes and no for the threshold; a guardian's
    no is a veto.
    """
    vote = F.col("vote")
    c = members.groupBy(*by).agg(
        F.count("*").alias("eligible"),
        F.count(vote).alias("turnout"),
        *[F.count_if(vote == v).alias(v) for v in ("yes", "no", "abstain")],
        F.bool_or(F.coalesce((vote == "no") & F.col("guardian"), F.lit(False))).alias("veto"),
    )
    decisive = F.col("yes") + F.col("no")
    c = c.withColumn("quorum_met", F.col("turnout") * 100 >= quorum_percent * F.col("eligible"))
    c = c.withColumn("threshold_met", (decisive > 0) & (F.col("yes") * 100 >= approval_percent * decisive))
    return c.withColumn("approved", F.col("quorum_met") & F.col("threshold_met") & ~F.col("veto"))


def ballot_errors(ballots: DataFrame, members: DataFrame, by: list[str]) -> DataFrame:
    """Voters that aren't members, and members that vote more than once: (by, member_id, code)."""
    key = [*by, "member_id"]
    unknown = ballots.join(members.select(*key).distinct(), key, "left_anti").select(*key, F.lit("VOTER_INELIGIBLE").alias("code"))
    twice = ballots.groupBy(*key).count().filter("count > 1").select(*key, F.lit("VOTER_DUPLICATE").alias("code"))
    return unknown.unionByName(twice).distinct()


def needed(percent: Column, members: Column) -> Column:
    """The least whole number of members that is ``percent`` of them."""
    return F.floor((percent * members + 99) / 100).cast("int")


def clamped(c: Column, low: int = 0, high: int = 100) -> Column:
    return F.least(F.greatest(c, F.lit(low)), F.lit(high))


def ballots(members: DataFrame, by: str, member: str, mode: str, percent: str, quorum: str) -> DataFrame:
    """``members`` with vote: the ballots of a council that ends as its ``mode`` says.

    approved: as many yes as its ``percent`` needs, the rest no. quorum_failure: one vote
    fewer than its ``quorum`` needs, but one at least, the rest null. Others: all no.
    """
    w = Window.partitionBy(by).orderBy(member)
    n, i = F.count("*").over(Window.partitionBy(by)), F.row_number().over(w)
    enough = i <= needed(F.col(percent), n)
    voting = i <= F.greatest(F.lit(1), needed(F.col(quorum), n) - 1)
    vote = F.when(F.col(mode) == "approved", F.when(enough, "yes").otherwise("no")).when(F.col(mode) == "quorum_failure", F.when(voting, "yes")).otherwise(F.lit("no"))
    return members.withColumn("vote", vote)

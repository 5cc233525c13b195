"""Player scoring: optional filters, engagement score, tier and overall rank."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import contains_text, first_match, has_digit
from ..operators.ordered import global_rank
from ..sources.staging import stage

# Score weights.
GAMES, TIME, PROMOTIONS, VISITS = "0.3", "0.4", "0.2", "0.1"


def player_tiers(players: DataFrame, min_bet: float = 500, risk: str | None = None, keyword: str | None = None,
                 anchored_digit: bool = False) -> DataFrame:
    """Tiers without the rank. Arguments left at None add no predicate; rows without a player id are dropped.

    The score is summed in decimal, so a player exactly on a threshold is not lost to rounding. A NULL
    first name makes the digit test unknown, which keeps the player out of Gold.
    """
    rows = players.filter((F.col("amntbet") >= min_bet) & F.col("playerid").isNotNull())
    if risk is not None:
        rows = rows.filter(F.col("risk_category") == risk)
    if keyword is not None:
        rows = rows.filter(contains_text(F.col("location"), keyword))
    part = lambda c, w: F.coalesce(F.col(c).cast("decimal(20,2)"), F.lit(0)) * F.lit(w).cast("decimal(2,1)")
    score = (part("total_no_games", GAMES) + part("time_spent", TIME)
             + part("value_of_promotions_used", PROMOTIONS) - part("visit_frequency_days", VISITS))
    known = (contains_text(F.coalesce("location", F.lit("")), keyword) if keyword is not None else F.lit(False))
    rows = rows.withColumns({
        "engagementscore": score.cast("double"),
        "namehasdigits": has_digit(F.col("firstname"), anchored_digit),
        "loccontainskeyword": known,
        "ageint": F.col("age").try_cast("int"),
    })
    points, visits, age = F.col("engagementscore"), F.coalesce("visit_frequency_days", F.lit(999)), F.col("ageint")
    tier = first_match([
        ((points >= 80) & (visits <= 5) & ~F.col("namehasdigits") & age.between(25, 45), F.lit("Gold")),
        ((points >= 50) & (visits <= 10) & F.col("loccontainskeyword"), F.lit("Silver")),
        ((points >= 30) & (F.coalesce(age, F.lit(0)) < 25), F.lit("Bronze")),
    ], F.lit("Newbie"))
    return rows.select("playerid", tier.alias("playertier"), "engagementscore", "risk_category", "namehasdigits",
                       "loccontainskeyword", "ageint")


def rank_order() -> list[Column]:
    return [F.col("playerrank").asc_nulls_last(), F.col("playertier").desc_nulls_first(), F.col("engagementscore").desc_nulls_first()]


def player_report(players: DataFrame, min_bet: float = 500, risk: str | None = None, keyword: str | None = None,
                  anchored_digit: bool = False) -> DataFrame:
    """Tiers ranked over all players by score, then id, in rank order."""
    tiers = stage(player_tiers(players, min_bet, risk, keyword, anchored_digit), "tiers")  # ranking reads it several times
    return global_rank(tiers, {"engagementscore": False, "playerid": True}, "playerrank").orderBy(*rank_order())

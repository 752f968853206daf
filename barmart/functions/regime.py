"""Rule-based label for the state of a series."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Labels and thresholds (percent, percent, RSI points).
UNKNOWN = "unknown"
NEUTRAL = "neutral"
STRONG_MOVE = 10
CALM_MOVE = 5
QUIET_MOVE = 2
WIDE_SPREAD = 5.0


def regime_label(move_7: Column, spread: Column, rsi: Column) -> Column:
    """Label of one bar; the first rule that holds wins.

    The two reversing labels are part of the rule list but the trending rules before
    them cover their whole range, so they never come out; a fall of more than 10 %
    with an RSI above 65 counts as bullish. Both follow from the rule order.
    """
    # The labels, the RSI limits and the order of the rules.
    size = F.abs(move_7)
    wide = spread > WIDE_SPREAD
    rules = [
        (UNKNOWN, move_7.isNull() | spread.isNull() | rsi.isNull()),
        ("trending_bullish", (size > STRONG_MOVE) & (rsi > 65)),
        ("trending_bearish", (size > STRONG_MOVE) & (rsi < 35)),
        ("ranging_volatile", wide & (size < CALM_MOVE)),
        ("ranging_quiet", ~wide & (size < QUIET_MOVE)),
        ("reversing_oversold", (move_7 < -STRONG_MOVE) & (rsi < 30)),
        ("reversing_overbought", (move_7 > STRONG_MOVE) & (rsi > 70)),
    ]
    chain = reduce(lambda acc, rule: acc.when(rule[1], F.lit(rule[0])), rules[1:], F.when(rules[0][1], F.lit(UNKNOWN)))
    return chain.otherwise(F.lit(NEUTRAL))

"""Rates, weights, labels and parsing, as column expressions. Everything is double where it divides."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from lakeloom.functions.names import normalize_name

# Shots per 90, share on target and conversion that a position starts from.
POSITION_PRIORS = {"F": (2.6, 0.42, 0.16), "M": (1.2, 0.35, 0.10), "D": (0.5, 0.25, 0.05), "G": (0.0, 0.0, 0.0)}
# Names of positions; anything else is M.
POSITION_NAMES = {"F": ["F", "A", "ATTACKER", "FORWARD", "STRIKER"], "D": ["D", "DEFENDER", "DEFENCE"], "G": ["G", "GK", "GOALKEEPER"]}
# Weights of competitions; the first label found in the name counts.
STAKE_WEIGHTS = [("world cup group stage", 1.0), ("world cup", 1.0), ("qualifier", 0.7), ("qualifiers", 0.7), ("friendly", 0.2), ("friendly matches", 0.2)]
# Words of a competition that make it count for much.
HIGH_STAKES = ["world cup", "euro", "copa america", "copa américa", "africa cup", "asian cup", "gold cup", "nations league", "qualifier", "qualification", "playoff", "play-off"]
# Words of an error that tell that a quota is used up.
QUOTA_WORDS = ["rate limit", "too many request", "too many requests", "quota", "requests limit", "request limit", "subscription", "exceeded"]

PRIOR_MINUTES, FULL_MINUTES, ELO_START, ELO_DIVISOR, HALF_LIFE_DAYS = 270.0, 450.0, 1500.0, 900.0, 365.0


def _any_of(col: Column, words: list[str]) -> Column:
    out = F.lit(False)
    for w in words:
        out = out | F.contains(col, F.lit(w))
    return out


def bucket(col: Column, mapping: dict[str, list[str]], default: str) -> Column:
    """The name whose list holds the upper-cased value, else ``default``; null too."""
    out = F.lit(default)
    for name, values in reversed(mapping.items()):
        out = F.when(F.upper(col).isin(values), name).otherwise(out)
    return out


def position_group(col: Column) -> Column:
    return bucket(col, POSITION_NAMES, "M")


def prior(col: Column, which: int) -> Column:
    """Prior of a position group: 0 shots per 90, 1 share on target, 2 conversion."""
    out = F.lit(POSITION_PRIORS["M"][which])
    for name, values in POSITION_PRIORS.items():
        out = F.when(col == name, F.lit(values[which])).otherwise(out)
    return out


def default_alpha(group: Column) -> Column:
    """Shots a position is given before any are seen, over PRIOR_MINUTES."""
    return prior(group, 0) * (PRIOR_MINUTES / 90.0)


def per_90(amount: Column, minutes: Column) -> Column:
    """Amount for 90 minutes; 0 if no minutes were played or known."""
    return F.when(minutes > 0, amount * F.lit(90.0) / minutes).otherwise(F.lit(0.0))


def smoothed_rate(alpha: Column, beta: Column, amount: Column, minutes: Column) -> Column:
    """(alpha + amount) / (beta + minutes), 0 where that can't be formed."""
    below = beta + minutes
    return F.when(below > 0, (alpha + amount).cast("double") / below).otherwise(F.lit(0.0))


def recency_weight(date: Column, as_of: Column | None, half_life: float = HALF_LIFE_DAYS) -> Column:
    """Half for each ``half_life`` days before ``as_of``; 1 for later or unknown dates, or if ``as_of`` is None."""
    if half_life <= 0:
        raise ValueError("half_life must be positive")
    if as_of is None:
        return F.lit(1.0)
    age = (F.unix_timestamp(as_of.cast("timestamp")) - F.unix_timestamp(date.cast("timestamp"))) / F.lit(86400.0)
    return F.exp(F.lit(-0.6931471805599453 / half_life) * F.greatest(F.lit(0.0), F.coalesce(age, F.lit(0.0))))


def stake_weight(label: Column) -> Column:
    """Weight of a competition by the first label its name holds; 1 for others and for none."""
    key = normalize_name(label, "player")
    out = F.lit(1.0)
    for word, weight in reversed(STAKE_WEIGHTS):
        out = F.when(F.contains(key, F.lit(word)), F.lit(weight)).otherwise(out)
    return F.coalesce(out, F.lit(1.0))


def high_stakes(label: Column) -> Column:
    """1 for a competition that counts, 0 for friendlies and others."""
    low = F.lower(F.coalesce(label, F.lit("")))
    return F.when(_any_of(low, ["friendly", "friendlies"]), 0).when(_any_of(low, HIGH_STAKES), 1).otherwise(0)


def clip(col: Column, low: float, high: float) -> Column:
    return F.least(F.greatest(col, F.lit(low)), F.lit(high))


def opponent_strength(elo: Column, containment: Column) -> Column:
    """exp((elo - 1500) / 900) / containment between 0.5 and 1.8; a containment that isn't positive counts as 1."""
    held = F.when(containment > 0, containment).otherwise(F.lit(1.0))
    return clip(F.exp((F.coalesce(elo, F.lit(ELO_START)) - ELO_START) / ELO_DIVISOR) / held, 0.5, 1.8)


def elo_anchor(elo: Column) -> Column:
    return F.exp((F.lit(ELO_START) - F.coalesce(elo, F.lit(ELO_START))) / ELO_DIVISOR)


def elo_expected(a: Column, b: Column) -> Column:
    return F.lit(1.0) / (F.lit(1.0) + F.pow(F.lit(10.0), (b - a) / 400.0))


def gap_weight(gap: Column) -> Column:
    """1 + gap / 1000 between 0.85 and 1.25; an unknown gap counts as 0."""
    return clip(F.lit(1.0) + F.coalesce(gap, F.lit(0.0)) / 1000.0, 0.85, 1.25)


def result_points(difference: Column) -> Column:
    return F.when(difference > 0, 3.0).when(difference == 0, 1.0).otherwise(0.0)


def opponent_of(team: Column, home: Column, away: Column, strict: bool = True) -> Column:
    """The other side. ``strict``: null if the team is neither; else the home side for any team that isn't it."""
    if strict:
        return F.when(team == home, away).when(team == away, home)
    return F.when(team == home, away).otherwise(home)


def blended(seen: Column, prior_value: Column, weight: Column) -> Column:
    return weight * seen + (F.lit(1.0) - weight) * prior_value


def error_text(col: Column) -> Column:
    """White space collapsed, at most 500 characters."""
    return F.substring(F.trim(F.regexp_replace(col, r"\s+", " ")), 1, 500)


def is_quota_error(col: Column) -> Column:
    """Whether an error's text tells of a used-up quota; no error: False."""
    return F.coalesce(_any_of(F.lower(col), QUOTA_WORDS), F.lit(False))


def fingerprint(*cols: Column | str) -> Column:
    """SHA-256 of a struct's JSON; the order of the columns given is the order of its keys."""
    return F.sha2(F.to_json(F.struct(*cols)), 256)


def change_text(factor: Column, team: Column, opponent: Column) -> Column:
    """A factor as a sentence on by how many percent it raises or lowers a team's chances; an error if it isn't finite."""
    valid = factor.isNotNull() & ~F.isnan(factor) & (F.abs(factor) != float("inf"))
    percent = F.when(valid, F.bround((factor - 1.0) * 100).cast("int")).otherwise(F.raise_error(F.lit("factor isn't a finite number")).cast("int"))
    some = lambda verb: F.concat(opponent, F.lit(f"'s defence {verb} "), team, F.lit("'s chances by ~"), F.abs(percent).cast("string"), F.lit("%"))
    return F.when(percent > 0, some("increases")).when(percent < 0, some("decreases")).otherwise(F.lit("neutral 0% effect"))


def minutes_between(earlier: Column, later: Column) -> Column:
    """Whole minutes from one time to another."""
    return F.timestamp_diff("MINUTE", earlier, later)

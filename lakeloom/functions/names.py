"""Keys and labels from names, as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Accented letters, lower case, and the plain letters they stand for, one for one.
ACCENTED = "àáâãäåāăąçćčðďèéêëēĕėęěìíîïīįıłñńňòóôõöøōőřśşšùúûüūůűýÿžźżğșțť"
PLAIN = "aaaaaaaaacccddeeeeeeeeeiiiiiiilnnnoooooooorsssuuuuuuuyyzzzgstt"
# Letters that stand for two.
DOUBLE = {"ß": "ss", "æ": "ae", "œ": "oe"}
# Other spellings of a team's key.
TEAM_ALIASES = {"cote d ivoire": "ivory coast", "cote divoire": "ivory coast", "cote d lvoire": "ivory coast", "ivory coast": "ivory coast"}

assert len(ACCENTED) == len(PLAIN)


def fold_accents(col: Column, cased: bool = False) -> Column:
    """Letters without their accents; combining marks are dropped. ``cased``: capitals are folded too, else they should
    be lower-cased before."""
    col = F.regexp_replace(col, r"\p{M}+", "")
    accented, plain, double = ACCENTED, PLAIN, dict(DOUBLE)
    if cased:
        pairs = [(a.upper(), p.upper()) for a, p in zip(ACCENTED, PLAIN) if len(a.upper()) == 1 and a.upper() != "I"] + [("İ", "I")]
        accented, plain = ACCENTED + "".join(a for a, _ in pairs), PLAIN + "".join(p for _, p in pairs)
        double |= {"Æ": "AE", "Œ": "OE"}
    col = F.translate(col, accented, plain)
    for letter, two in double.items():
        col = F.replace(col, F.lit(letter), F.lit(two))
    return col


def normalize_name(col: Column, mode: str = "key") -> Column:
    """A comparable form of a name. Null stays null.

    ``key``: lower case, accents folded, other characters to single spaces. ``player``: as key, but punctuation stays.
    ``alias``: key with the team aliases applied. ``slug``: key joined by underscores. ``label``: no accent folding, so
    accented letters part words. ``display``: accents folded, case and punctuation kept.
    """
    text = F.trim(col)
    if mode == "display":
        return fold_accents(col, cased=True)
    low = F.lower(text)
    if mode == "label":
        return F.trim(F.regexp_replace(low, "[^a-z0-9]+", " "))
    low = fold_accents(low)
    if mode == "player":
        return F.trim(F.regexp_replace(low, r"\s+", " "))
    key = F.trim(F.regexp_replace(low, "[^a-z0-9]+", " "))
    if mode == "slug":
        return F.replace(key, F.lit(" "), F.lit("_"))
    if mode == "alias":
        aliases = F.create_map(*[F.lit(x) for pair in TEAM_ALIASES.items() for x in pair])
        return F.coalesce(F.try_element_at(aliases, key), key)
    if mode != "key":
        raise ValueError(f"unknown mode {mode!r}")
    return key

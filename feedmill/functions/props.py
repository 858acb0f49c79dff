"""Property bags: ``k:v|k:v`` strings.

Log producers are read under three rules, which differ in what they make of a
pair with no value or with several colons:

``FIRST``  the value is the text between the first and second colon, and one
           pair without a value spoils the whole bag.
``PAIR``   only ``k:v`` and ``k`` (an empty value) count, ``k:a:b`` is ignored.
``REST``   the value is all that follows the first colon.

Under every rule trailing colons of a pair and trailing bars of a bag are
ignored, and the last pair with a key wins.

A plain ``k:v`` pair, which is nearly all of them, is found by byte search;
patterns only decide the odd forms.  Both stay inside generated code, where a
``transform`` over a split array would not.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

FIRST, PAIR, REST = "first", "pair", "rest"

# The value as the one capturing group, in a bag framed by bars.
_ODD_FORM = {
    PAIR: r"(?s)^.*\|{key}(?::([^:|]+))?:*+\|",
    REST: r"(?s)^.*\|{key}(?::([^|]*?))?:*\|",
}


def framed(bag: Column) -> Column:
    """The bag with a bar on either side, the form that all functions here take."""
    return F.concat(F.lit("|"), bag, F.lit("|"))


def prop(bag: Column, key: str, rule: str) -> Column:
    """Value of ``key``: NULL when absent, '' when present without a value."""
    opening, bare = F.lit(f"|{key}:"), F.lit(f"|{key}|")
    rest = F.substring_index(F.substring_index(bag, f"|{key}:", -1), "|", 1)
    if rule == FIRST:
        return F.when(F.contains(bag, opening), F.substring_index(rest, ":", 1))
    odd = _ODD_FORM[rule].format(key=key)
    by_pattern = F.when(bag.rlike(odd), F.regexp_extract(bag, odd, 1))
    if rule == REST:
        return F.when(F.contains(bag, bare), by_pattern).when(
            F.contains(bag, opening), F.rtrim(rest, F.lit(":"))
        )
    return F.when(F.contains(bag, bare) | F.contains(rest, F.lit(":")), by_pattern).when(
        F.contains(bag, opening), rest
    )


def readable(bag: Column, rule: str) -> Column:
    """False for a bag that the rule cannot read, which rejects its record."""
    if rule == FIRST:
        return ~F.concat(F.rtrim(bag, F.lit("|")), F.lit("|")).rlike(r"^\|$|\|[^:|]*+:*+\|")
    if rule == REST:
        return ~F.contains(bag, F.lit("|:")) | ~bag.rlike(r"\|:++\|")
    return bag.isNotNull()


def repeats(bag: Column, key: str) -> Column:
    """True when ``key`` occurs in two pairs or more."""
    opening = f"|{key}:"
    removed = F.length(bag) - F.length(F.replace(bag, F.lit(opening), F.lit("")))
    return F.when(F.contains(bag, F.lit(f"|{key}|")), bag.rlike(rf"(?s)\|{key}(?=[:|]).*\|{key}[:|]")).otherwise(
        removed >= 2 * len(opening)
    )

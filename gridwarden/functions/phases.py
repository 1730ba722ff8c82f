"""Phase codes as 3-bit masks (A=4, B=2, C=1)."""

from __future__ import annotations

from gridwarden.functions import values
from gridwarden.functions.text import mapped

PHASES = {"A": 4, "B": 2, "C": 1}


def phase_count(code: str) -> str:
    """Phases in a code; NULL when the code is missing or outside 1..7."""
    return mapped(code, values.PHASE_COUNT)


def phase_letters(code: str) -> str:
    return mapped(code, values.PHASE_LETTERS)


def phases_outside(code: str, allowed: str) -> str:
    """True if `code` has a phase `allowed` lacks; not true if either is no phase code."""
    return f"({code} between 1 and 7 and {allowed} between 1 and 7 and ({code} & ~{allowed}) <> 0)"


def letters_outside(text: str, allowed: str) -> str:
    """True if the text has a character, blanks aside, that is no letter of the `allowed` code."""
    lacking = " or ".join(f"(contains({text}, '{letter}') and ({allowed} & {bit}) = 0)" for letter, bit in PHASES.items())
    return f"({allowed} between 1 and 7 and (translate({text}, 'ABC ', '') <> '' or {lacking}))"

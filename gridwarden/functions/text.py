"""Text and number expressions with the report's NULL rules: NULL joins as nothing, empty is NULL.

Expressions are SQL text, so a rule's conditions are built without a call into the JVM per operator.
"""

from __future__ import annotations

from collections.abc import Mapping


def literal(value: str | int | None) -> str:
    if isinstance(value, str):
        return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"
    return "null" if value is None else str(value)


def mapped(code: str, table: Mapping[int, str | int]) -> str:
    """The table's value for a small non-negative code, NULL for any other code.

    One look into a constant array: a CASE would repeat `code` per entry and swell the generated code.
    """
    entries = ", ".join(literal(table.get(i)) for i in range(max(table) + 1))
    return f"get(array({entries}), try_cast({code} as int))"


def joined(*parts: str) -> str:
    """The expressions as one text; a NULL adds nothing."""
    return "concat_ws('', " + ", ".join(f"cast({part} as string)" for part in parts) + ")"


def piece(text: str, start: int, length: int) -> str:
    """A substring, NULL where the text is too short to have it."""
    return f"nullif(substring({text}, {start}, {length}), '')"


def to_power(value: str) -> str:
    """A power written with `.` or `,` as a decimal; NULL if it is no number."""
    return f"try_cast(replace({value}, ',', '.') as decimal(28,10))"


def number_text(value: str) -> str:
    """A number with at most two decimals and no trailing zeros."""
    return f"regexp_replace(cast(cast(round({value}, 2) as decimal(38,2)) as string), '[.]?0+$', '')"

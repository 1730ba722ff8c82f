"""Conditions on single rows, as SQL expressions: each says which rows break a rule."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import NamedTuple

from gridwarden.functions.phases import phase_count
from gridwarden.functions.text import joined, literal, mapped


class Message(NamedTuple):
    """A text, an expression, for the rows that meet a condition."""

    broken: str
    text: str

    @property
    def value(self) -> str:
        return f"if({self.broken}, {self.text}, null)"


def code_count_mismatch(code: str, subtype: str, phases_of: Mapping[int, int]) -> tuple[str, str, str]:
    """Flag, phases by code (0 for no phase code), phases by subtype; an unlisted subtype is not flagged."""
    by_code, by_subtype = f"coalesce({phase_count(code)}, 0)", mapped(subtype, phases_of)
    return f"{by_code} <> {by_subtype}", by_code, by_subtype


def code_map_mismatch(code: str, actual: str, expected_of: Mapping[int, int]) -> tuple[str, str]:
    """Flag and expected value. A missing value is flagged; an unlisted code with a value is not."""
    expected = mapped(code, expected_of)
    return f"({code} is not null and ({actual} is null or {actual} <> {expected}))", expected


def conformance(*messages: Message) -> str:
    """True where any of the messages applies."""
    return "(" + " or ".join(f"({m.broken})" for m in messages) + ")"


def message_pair(first: Message, second: Message) -> str:
    """Two messages around a semicolon; one that does not apply leaves its side empty."""
    return joined(first.value, literal(";"), second.value)


def missing(columns: Sequence[str]) -> str:
    """True where any of the columns is NULL."""
    return "(" + " or ".join(f"{column} is null" for column in columns) + ")"


def null_or_range(column: str, low: int, high: int) -> str:
    """True where the value is NULL or outside low..high."""
    return f"({column} is null or {column} not between {low} and {high})"


def child_count_mismatch(expected: str, units: str) -> str:
    """True where the number of children, 0 for none, is not the expected one."""
    return f"coalesce({units}, 0) <> {expected}"


def child_sum_mismatch(expected: str, total: str) -> str:
    """True where the children's sum is not the parent's value, both to two decimals."""
    return f"round({expected}, 2) <> round({total}, 2)"

"""The findings schema, and how flagged rows of a table become findings."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import types as T

from gridwarden.functions.text import literal
from gridwarden.operators.joins import Lookup

COLUMNS = [
    "category",
    "rule",
    "feeder_id",
    "feeder_name",
    "element",
    "object_id",
    "detail_1",
    "detail_2",
    "run_date",
    "created_by",
    "created_at",
    "modified_by",
    "modified_at",
]
FEATURE = [
    "alimentadorid as feeder_id",
    "objectid as object_id",
    "usuarioregistro as created_by",
    "fecharegistro as created_at",
    "usuariomodificacionregistro as modified_by",
    "fechamodificacionregistro as modified_at",
]
MARKS = ["rule_id", "element", "detail_1", "detail_2", *[column.split(" as ")[1] for column in FEATURE]]
NO_TEXT = "cast(null as string)"
FILTER_LENGTH = 500


def findings_schema(audit_date: str = "date") -> T.StructType:
    """The 13 columns; audit times are dates unless the network's tables hold timestamps."""
    audit = T.TimestampType() if audit_date == "timestamp" else T.DateType()
    special = {"object_id": T.LongType(), "run_date": T.DateType(), "created_at": audit, "modified_at": audit}
    return T.StructType([T.StructField(c, special.get(c, T.StringType())) for c in COLUMNS])


@dataclass(frozen=True)
class Check:
    """A condition on the rows of one table, and the finding it makes; details are expressions.

    A view of two sides, told apart by its column `_side`, has an element for each.
    `copies` is how often a flagged row is reported, such as once per child. With `each`, an array, it is reported once
    per element, which the details know as `_each`; a view has one such array at most.
    """

    rule_id: str
    element: str | tuple[str, str]
    flagged: str
    detail_1: str = NO_TEXT
    detail_2: str = NO_TEXT
    copies: str = "1L"
    each: str | None = None


def marks(
    rows: DataFrame, rule_id: str, element: str, detail_1: str = NO_TEXT, detail_2: str = NO_TEXT, *extra: str
) -> DataFrame:
    """What a finding says about a feature, from rows with the feature's id, feeder and audit columns."""
    texts = [f"{rule_id} as rule_id", f"{element} as element", f"{detail_1} as detail_1", f"{detail_2} as detail_2"]
    return rows.selectExpr(*texts, *FEATURE, *extra)


def summary_marks(
    rows: DataFrame,
    rule_id: str,
    element: str,
    object_id: str,
    detail_1: str,
    audit_date: str,
    detail_2: str = NO_TEXT,
) -> DataFrame:
    """What a finding says that names no feeder, author or date."""
    return rows.selectExpr(
        f"{literal(rule_id)} as rule_id",
        f"{literal(element)} as element",
        f"{detail_1} as detail_1",
        f"{detail_2} as detail_2",
        f"{NO_TEXT} as feeder_id",
        f"cast({object_id} as bigint) as object_id",
        f"{NO_TEXT} as created_by",
        f"cast(null as {audit_date}) as created_at",
        f"{NO_TEXT} as modified_by",
        f"cast(null as {audit_date}) as modified_at",
    )


def picked(values: Sequence[str], place: str) -> str:
    """The text at a place of a constant list."""
    return f"get(array({', '.join(map(literal, values))}), {place})"


def flag_rows(rows: DataFrame, checks: Sequence[Check]) -> DataFrame:
    """Marks of all checks in one pass over the rows; a row gives one mark per check it fails.

    The marks have a column `copies` if a check reports rows more than once.

    Texts are built only for flagged rows. One short condition is a filter, which reaches the scan.
    Others stand in a generator, below which Catalyst computes a derived column once instead of
    repeating it per mention; the generated method stays small enough for the JVM to compile.
    """
    only = checks[0]
    repeated = any(check.copies != Check.copies for check in checks)
    if len(checks) == 1 and len(only.flagged) <= FILTER_LENGTH:
        element = literal(only.element) if isinstance(only.element, str) else picked(only.element, "_side")
        texts = literal(only.rule_id), element, only.detail_1, only.detail_2
        flagged = rows.where(only.flagged)
        flagged = flagged.selectExpr("*", f"explode({only.each}) as _each") if only.each else flagged
        return marks(flagged, *texts, *([f"{only.copies} as copies"] if repeated else []))
    failed = ", ".join(f"if({check.flagged}, {i}, null)" for i, check in enumerate(checks))
    hits = rows.selectExpr("*", f"explode(array({failed})) as _check").where("_check is not null")

    arrays = {check.each for check in checks if check.each}
    for each in arrays:
        listed = ", ".join(str(i) for i, check in enumerate(checks) if check.each)
        hits = hits.selectExpr("*", f"explode(if(_check in ({listed}), {each}, array(get({each}, -1)))) as _each")

    def constant(values: list[str]) -> str:
        return literal(values[0]) if len(set(values)) == 1 else picked(values, "_check")

    def chosen(values: list[str]) -> str:
        if len(set(values)) == 1:
            return values[0]
        return "case _check " + " ".join(f"when {i} then {value}" for i, value in enumerate(values)) + " end"

    elements = [check.element for check in checks]
    two_sided = isinstance(elements[0], tuple)
    return marks(
        hits,
        constant([check.rule_id for check in checks]),
        picked([name for pair in elements for name in pair], "2 * _check + _side") if two_sided else constant(elements),
        chosen([check.detail_1 for check in checks]),
        chosen([check.detail_2 for check in checks]),
        *([f"{chosen([check.copies for check in checks])} as copies"] if repeated else []),
    )


def enrich_feeder(rows: DataFrame, feeders: Lookup) -> DataFrame:
    """Adds the feeder's name, NULL for an unknown feeder. Rows never multiply."""
    return feeders.join_value(rows, "feeder_id", "object_id", "feeder_name")


def as_findings(
    rows: DataFrame, titles: Mapping[str, tuple[str, str]], feeders: Lookup, run_date: date, audit_date: str
) -> DataFrame:
    """Findings, with a leading `rule_id`, from marks."""

    def title(part: int) -> str:
        if len(titles) == 1:
            return literal(next(iter(titles.values()))[part])
        entries = ", ".join(f"{literal(rule_id)}, {literal(title[part])}" for rule_id, title in titles.items())
        return f"element_at(map({entries}), rule_id)"

    titled = rows.selectExpr("*", f"{title(0)} as category", f"{title(1)} as rule")
    typed = {f.name: f.dataType.simpleString() for f in findings_schema(audit_date)}
    columns = [f"cast({name} as {kind}) as {name}" for name, kind in typed.items() if name != "run_date"]
    columns.insert(COLUMNS.index("run_date"), f"date '{run_date.isoformat()}' as run_date")
    return enrich_feeder(titled, feeders).selectExpr("rule_id", *columns)

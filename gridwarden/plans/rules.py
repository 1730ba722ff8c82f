"""The validation rules R01..R23.

A rule is either a list of checks per view, where a view is a table with what its rows need to be
judged alone, or a relational plan of its own. Checks of several rules on one view share its scan
and its shuffles.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Sequence
from dataclasses import dataclass
from datetime import date
from functools import partial, reduce

from pyspark.sql import DataFrame
from pyspark.sql import types as T

from gridwarden.functions import values
from gridwarden.functions.phases import letters_outside, phase_count, phase_letters, phases_outside
from gridwarden.functions.text import joined, literal, mapped, number_text, piece, to_power
from gridwarden.operators import checks as c
from gridwarden.operators.checks import Message
from gridwarden.operators.children import child_totals, with_child_totals, with_repeated_values, wrong_parent
from gridwarden.operators.duplicates import conditional_summary, duplicate_key, matched_totals, rows_missing_key
from gridwarden.operators.findings import COLUMNS, MARKS, NO_TEXT, Check, as_findings, flag_rows, marks, summary_marks
from gridwarden.operators.joins import inner_join, is_hot, repeat_rows, spread_join
from gridwarden.sources.network import AUDIT, Network

PHASE = "faseconexion"
SWITCH, CAPACITOR, TRANSFORMER = "Seccionador Fusible", "Capacitor", "Puesto Transformador"
CONNECTION = "Conexion Consumidor"
#: The codes that units are counted by in columns, where units have no others.
UNIT_PHASES = sorted({0, *values.PHASE_LETTERS})


# --- Views ----------------------------------------------------------------------------------


def power(frame: DataFrame, column: str) -> str:
    """A power column as a decimal, whether the source holds text or numbers."""
    kind = frame.schema[column].dataType
    if isinstance(kind, T.DecimalType):
        return column
    return to_power(column) if isinstance(kind, T.StringType) else f"try_cast({column} as decimal(28,10))"


def power_totals(units: DataFrame) -> dict[str, str]:
    """The sum of the units' power, where NULL and unreadable texts count as 0, and how many are unreadable."""
    value = power(units, "potencianominal")
    unreadable = "0L" if value == "potencianominal" else f"count_if(potencianominal is not null and {value} is null)"
    return {"_power": f"sum(coalesce({value}, 0))", "_unreadable": unreadable if unreadable != "0L" else "cast(sum(0) as bigint)"}


def transformer_units(network: Network) -> DataFrame:
    units = network["unidadtransfdistribucion"]
    return with_repeated_values(
        network["puestotransfdistribucion"],
        "globalid",
        units,
        "puestotransfdistglobalid",
        PHASE,
        of_repeats={"_rows": "_repeats", "_phases": "coalesce(_value, 0) * _repeats"},
        codes=UNIT_PHASES if network.holds_only("unidadtransfdistribucion", PHASE, UNIT_PHASES) else None,
        hot=network.is_hot("puestotransfdistribucion", "globalid", nulls=True),
        _units="count(objectid)",
        **power_totals(units),
        _bad_taps=f"count_if({c.null_or_range('tapnormal', *values.TAP_RANGE)})",
    )


def capacitor_units(network: Network) -> DataFrame:
    units = network["unidadcapacitor"]
    return with_child_totals(
        network["puestocorrectorfactorpotencia"],
        "globalid",
        units,
        "puestocorrfacpotglobalid",
        hot=network.is_hot("puestocorrectorfactorpotencia", "globalid", nulls=True),
        _rows="count(1)",
        _units="count(objectid)",
        **power_totals(units),
    )


def fuse_switch_units(network: Network) -> DataFrame:
    return with_child_totals(
        network["puestoseccionadorfusible"],
        "globalid",
        network["unidadfusible"],
        "puestosecfusibleglobalid",
        hot=network.is_hot("puestoseccionadorfusible", "globalid", nulls=True),
        _units="count(objectid)",
        _no_capacity="count_if(capacidad is null)",
    )


def fuse_switch_structure(network: Network) -> DataFrame:
    return network.structures.join_rows(network["puestoseccionadorfusible"], "codigoestructura", "objectid", "_structure")


MEDIUM_SPANS = "tramodistribucionaereo", "tramodistribucionsubterraneo"
LOW_SPANS = "tramobajatensionaereo", "tramobajatensionsubterraneo"


def spans(network: Network, overhead: str, underground: str) -> DataFrame:
    """Both tables of a voltage as one; `_side` is 0 for overhead spans and 1 for underground ones."""
    sides = [network[table].selectExpr("*", f"{side} as _side") for side, table in enumerate((overhead, underground))]
    return sides[0].unionByName(sides[1])


def with_structures(network: Network) -> DataFrame:
    """Medium-voltage spans with how often their two conductor codes are in the catalog, 1 for a code that it lacks."""
    found = network.structures.join_count(spans(network, *MEDIUM_SPANS), "codigoconductorfase", "objectid", "_phase_entries")
    return network.structures.join_count(found, "codigoconductorneutro", "objectid", "_neutral_entries")


def no_feature(network: Network, summary: DataFrame) -> DataFrame:
    """A row that stands for no feature: object 0, no feeder and no audit values."""
    kinds = {name: network.audit_date if kind == "audit_date" else kind for name, kind in AUDIT.items()}
    nothing = [f"cast(null as {kind}) as {name}" for name, kind in {"alimentadorid": "string", **kinds}.items()]
    return summary.selectExpr("*", "0L as objectid", *nothing)


def connection_total(network: Network) -> DataFrame:
    """The number of connections without a client code."""
    return no_feature(network, network["conexionconsumidor"].where("codigocliente is null").selectExpr("count(1) as _no_code"))


def connection_totals(network: Network) -> DataFrame:
    """That number, and the connections of accounts without a meter, in all and by state."""
    unmetered = network["atributosconsumidor"].where("nummedidor is null")
    states = {name: f"edccod = {literal(code)}" for name, code in values.CONNECTION_STATES.items()}
    counted = matched_totals(network["conexionconsumidor"], unmetered, "codigocliente", {"_all": "true", **states})
    missing = "if(codigocliente is null, _rows, 0)"
    summary = conditional_summary(counted, {"_missing": missing, "_all": "_all", **{name: f"`{name}`" for name in states}})
    return no_feature(network, summary.selectExpr("*", "coalesce(_missing, 0) as _no_code"))


VIEWS: dict[str, Callable[[Network], DataFrame]] = {
    "medium": lambda n: spans(n, *MEDIUM_SPANS),
    "medium_structures": with_structures,
    "low": lambda n: spans(n, *LOW_SPANS),
    "light": lambda n: n["luminaria"],
    "load_point": lambda n: n["puntocarga"],
    "breaker": lambda n: n["puestoprotecciondinamico"],
    "transformer": lambda n: n["puestotransfdistribucion"],
    "transformer_units": transformer_units,
    "capacitor_units": capacitor_units,
    "fuse_switch": lambda n: n["puestoseccionadorfusible"],
    "fuse_switch_units": fuse_switch_units,
    "fuse_switch_structure": fuse_switch_structure,
    "connection_total": connection_total,
    "connection_totals": connection_totals,
}

# Views with the same rows and more columns: a batch that needs both reads only the wider one.
WIDER_VIEW = {
    "transformer": "transformer_units",
    "fuse_switch": "fuse_switch_units",
    "medium": "medium_structures",
    "connection_total": "connection_totals",
}


def unmeasured(network: Network) -> bool:
    """Copies that are not known to count rows of a table may be any number."""
    return True


# Whether one row of a view may be wanted very often, by what the copies of its marks count.
HOT_COPIES: dict[str, Callable[[Network], bool]] = {
    "transformer_units": lambda n: n.is_hot("unidadtransfdistribucion", "puestotransfdistglobalid"),
    "fuse_switch_units": lambda n: n.is_hot("unidadfusible", "puestosecfusibleglobalid"),
    "medium_structures": lambda n: is_hot(n.structures.most**2, 0),
}

Checks = list[tuple[str, Check]]


# --- Rules as checks on the rows of a view ------------------------------------------------------


def phase_vs_subtype(network: Network) -> Checks:
    layers = [
        ("medium", ("MTA", "MTS"), values.MEDIUM_VOLTAGE_PHASES),
        ("low", ("BTA", "BTS"), values.LOW_VOLTAGE_PHASES),
        ("transformer", "Transformadores", values.TRANSFORMER_PHASES),
    ]
    found = []
    for view, element, phases_of in layers:
        flagged, by_code, by_subtype = c.code_count_mismatch(PHASE, "subtipo", phases_of)
        texts = joined(literal(values.COUNT_BY_PHASE), by_code), joined(literal(values.COUNT_BY_SUBTYPE), by_subtype)
        found.append((view, Check("R01", element, flagged, *texts)))
    return found


def feeder_info(network: Network) -> Checks:
    flagged, expected = c.code_map_mismatch(PHASE, "alimentadorinfo", values.FEEDER_INFO)
    detail = joined(
        "'Fase='", phase_letters(PHASE), "' AlimentadorInfo esperado='", expected, "' actual='", "alimentadorinfo"
    )
    elements = {
        "low": ("Tramo Baja Aereo", "Tramo Baja Subterraneo"),
        "medium": ("Tramo Distribución Aereo", "Tramo Distribución Subterraneo"),
        "light": "Luminaria",
        "transformer": "Transformador",
        "fuse_switch": SWITCH,
    }
    found = [(view, Check("R03", element, flagged, detail)) for view, element in elements.items()]
    metered = f"{flagged} and subtipo <> {values.TOTALIZER_LOAD}"
    return [*found, ("load_point", Check("R03", "Punto Carga", metered, detail))]


def by_phase_code(per_count: dict[int, str | int]) -> str:
    """The value for the number of phases that the connection phase has."""
    return mapped(PHASE, {code: per_count[n] for code, n in values.PHASE_COUNT.items()})


def voltage_message() -> Message:
    """The voltage is not the one for the number of phases."""
    single, multi = values.SINGLE_PHASE_VOLTAGE, values.MULTI_PHASE_VOLTAGE
    text = by_phase_code({1: values.VOLTAGE_SINGLE, 2: values.VOLTAGE_MULTI, 3: values.VOLTAGE_MULTI})
    return Message(f"voltaje <> {by_phase_code({1: single, 2: multi, 3: multi})}", text)


def digit_message(text: str, texts: dict[int, str]) -> Message:
    """The text does not start with the number of phases."""
    return Message(f"{piece(text, 1, 1)} <> {by_phase_code({1: '1', 2: '2', 3: '3'})}", by_phase_code(texts))


def switch_structure(network: Network) -> Checks:
    voltage = voltage_message()
    phases = digit_message("_structure", values.STRUCTURE_PHASES)
    letter = Message(
        f"{piece('_structure', 2, 1)} <> {mapped('subtipo', values.SWITCH_STRUCTURE_LETTER)}",
        mapped("subtipo", values.STRUCTURE_SUBTYPE),
    )
    amperes = "trim(substring(_structure, 3, 3))"
    if isinstance(network["puestoseccionadorfusible"].schema["corriente"].dataType, T.StringType):
        differs = f"nullif({amperes}, '') <> nullif(trim(corriente), '')"
    else:
        differs = f"try_cast({amperes} as decimal(18,3)) <> corriente"
    listed = ", ".join(map(str, values.STRUCTURE_CURRENT))
    current = Message(f"{differs} and subtipo in ({listed})", mapped("subtipo", values.STRUCTURE_CURRENT))
    flagged = c.conformance(voltage, phases, letter, current)
    check = Check("R05", SWITCH, flagged, c.message_pair(voltage, phases), c.message_pair(letter, current))
    return [("fuse_switch_structure", check)]


def units_vs_phase(rule_id: str, view: str, element: str) -> Callable[[Network], Checks]:
    phases, units = phase_count(PHASE), "coalesce(_units, 0)"
    texts = joined(literal(values.COUNT_BY_PHASE), phases), joined(literal(values.COUNT_OF_UNITS), units)
    check = Check(rule_id, element, c.child_count_mismatch(phases, "_units"), *texts)
    return lambda network: [(view, check)]


def capacity_missing(network: Network) -> Checks:
    check = Check("R07", SWITCH, "_no_capacity > 0", literal(values.CAPACITY_MISSING), copies="_no_capacity")
    return [("fuse_switch_units", check)]


def unit_power(rule_id: str, view: str, element: str, station: str) -> Callable[[Network], Checks]:
    def checks(network: Network) -> Checks:
        own, units = power(network[station], "potenciakva"), "if(_rows is null, 0, _power)"
        parts = literal(f"{values.POWER_DIFFERS}. Puesto = "), number_text(own), literal(" Unidad = "), number_text(units)
        # A station with an unreadable unit can't be judged; it is reported with the texts that were not read.
        unread = "coalesce(_unreadable, 0) > 0"
        flagged = f"({own} is not null and ({unread} or {c.child_sum_mismatch(own, units)}))"
        note = f"if({unread}, {joined(literal(values.UNREADABLE_POWER), '_unreadable')}, null)"
        return [(view, Check(rule_id, element, flagged, joined(*parts), note))]

    return checks


def conductor_and_sequence(network: Network) -> Checks:
    empty = c.missing(["codigoconductorfase", "configuracionconductores", "secuenciafase"])
    outside = letters_outside("secuenciafase", PHASE)
    texts = {empty: values.CONDUCTOR_MISSING, outside: values.SEQUENCE_OUTSIDE}
    return [("medium", Check("R10", ("TMA", "TMS"), flagged, literal(text))) for flagged, text in texts.items()]


def conductor_and_voltage(network: Network) -> Checks:
    layout, neutral = "configuracionconductores", "codigoconductorneutro"
    complete = f"not {c.missing(['codigoconductorfase', neutral, PHASE, layout])}"
    phases, wires = f"coalesce({phase_count(PHASE)}, 0)", f"try_cast(substring({layout}, 2, 1) as int)"
    no_neutral = f"{neutral} = {literal(values.NO_NEUTRAL)}"
    voltage = voltage_message()
    digit = digit_message(layout, values.LAYOUT_PHASES)
    wired = Message(
        f"if({no_neutral}, {wires} <> {phases}, {wires} <= {phases})",
        f"if({no_neutral}, {literal(values.LAYOUT_NO_NEUTRAL)}, {literal(values.LAYOUT_NEUTRAL)})",
    )
    flagged = f"({complete} and {c.conformance(voltage, digit, wired)})"
    texts = voltage.value, c.message_pair(digit, wired)
    # The catalog adds no column; a code that it repeats repeats the findings.
    copies = "_phase_entries * _neutral_entries"
    return [("medium_structures", Check("R11", ("MTA", "MTS"), flagged, *texts, copies=copies))]


def breaker_values(network: Network) -> Checks:
    texts = {
        "corriente": values.CURRENT_MISSING,
        "corrientemaxcortocircuito": values.SHORT_CIRCUIT_MISSING,
        PHASE: values.PHASE_MISSING,
        "voltaje": values.VOLTAGE_MISSING,
    }
    current, short_circuit, phase, voltage = [Message(f"{column} is null", literal(text)) for column, text in texts.items()]
    pairs = c.message_pair(current, short_circuit), c.message_pair(phase, voltage)
    return [("breaker", Check("R12", "Puesto Proteccion Dinámico", c.missing(list(texts)), *pairs))]


def taps_and_sides(network: Network) -> Checks:
    sides = f"(_rows > 0 and {c.missing(['configuracionladobaja', 'configuracionladomedia'])})"
    found = [
        Check("R13", TRANSFORMER, "_bad_taps > 0", literal(values.TAP_INVALID), copies="_bad_taps"),
        Check("R13", TRANSFORMER, sides, literal(values.SIDE_MISSING), copies="_rows"),
    ]
    return [("transformer_units", check) for check in found]


def units_vs_subtype(network: Network) -> Checks:
    required, group = mapped("subtipo", values.TRANSFORMER_UNITS), mapped("subtipo", values.TRANSFORMER_GROUP)
    flagged = f"(_rows is not null and {c.child_count_mismatch(required, '_units')})"
    texts = (
        joined(group, "' creado con '", "_units", "' unidad(es)'"),
        joined("'Debe tener '", required, "' unidad(es)'"),
    )
    return [("transformer_units", Check("R14", TRANSFORMER, flagged, *texts))]


def station_vs_unit_phase(network: Network) -> Checks:
    station, units = f"coalesce({PHASE}, 0)", "coalesce(_phases, 0)"
    named = {0: values.NULL_PHASE, **values.PHASE_LETTERS}
    detail = joined(
        mapped("subtipo", values.TRANSFORMER_GROUP),
        "' no coinciden Fase de Conexión, Puesto='",
        mapped(station, named),
        "'  Unidad='",
        f"coalesce({mapped(units, named)}, {literal(values.UNKNOWN_PHASE)})",
    )
    parallel = Message(f"{phase_count(PHASE)} = 1 and _units > 1", literal(values.PARALLEL_NOTE))
    flagged = f"({station} <> {units} or {station} = 0)"
    return [("transformer_units", Check("R15", TRANSFORMER, flagged, detail, parallel.value))]


def bank_phases(network: Network) -> Checks:
    group = mapped("subtipo", values.TRANSFORMER_GROUP)
    station = joined(group, "' tiene Fase Conexion = '", phase_letters(PHASE))
    repeats = literal(f" veces;{values.PARALLEL_NOTE}")
    unit = joined("'Fase '", phase_letters("_each.value"), "' se repite en la unidad '", "_each.repeats", repeats)
    flagged = f"(subtipo in ({', '.join(map(str, values.BANK_SUBTYPES))}) and size(repeated) > 0)"
    return [("transformer_units", Check("R16", TRANSFORMER, flagged, station, unit, each="repeated"))]


RECORDS = "' registros'"


def records(total: str) -> str:
    return joined("'Existen '", total, RECORDS)


def no_meter(network: Network) -> Checks:
    by_state = "concat_ws('  ', " + ", ".join(joined(literal(f"{name}="), f"`{name}`") for name in values.CONNECTION_STATES) + ")"
    return [("connection_totals", Check("R20", CONNECTION, "true", records("_all"), by_state))]


def no_client_code(network: Network) -> Checks:
    return [("connection_total", Check("R21", CONNECTION, "true", records("_no_code")))]


# --- Rules with a plan of their own -------------------------------------------------------------


FED = ["objectid", "alimentadorid", PHASE, "parentcircuitsourceguid", *AUDIT]
#: What marks of fed features carry besides: a load point's key, and how often they count.
COUNTED = ["globalid", "once", "private_only", "times"]


def fed_features(network: Network, breakers: bool) -> DataFrame:
    """Lights, load points and, for the question of `breakers`, low-voltage spans, with the circuit that feeds them.

    `_phased` features must match their transformer, `_fed` ones must not hang from a breaker that is its own parent.
    """

    def taken(table: str, element: str, phased: str, fed: str, *counted: str) -> DataFrame:
        return network[table].selectExpr(*FED, f"{literal(element)} as _element", f"{phased} as _phased", f"{fed} as _fed", *counted)

    plain = "cast(null as string) as globalid", "true as once", "false as private_only"
    private_only = f"coalesce(subtipo = {values.TOTALIZER_LOAD}, false) as private_only"
    not_medium = f"coalesce(subtipo <> {values.MEDIUM_VOLTAGE_LOAD}, false)"
    frames = [
        taken("luminaria", "Luminaria", "true", "true", *plain),
        taken("puntocarga", "Punto Carga", "true", not_medium, "globalid", "false as once", private_only),
    ]
    if breakers:
        elements = {LOW_SPANS[0]: "Tramo Baja Aereo", LOW_SPANS[1]: "Tramo Baja Subterraneo"}
        frames += [taken(table, element, "false", "true", *plain) for table, element in elements.items()]
    return reduce(DataFrame.unionByName, frames)


def fed_marks(network: Network, rule_ids: set[str]) -> DataFrame:
    """Marks of R02, features with a phase that their transformer lacks, and of R04, features that hang from a breaker which
    is its own parent; one pass over the features for both."""
    rows, asked = fed_features(network, "R04" in rule_ids), []
    if "R04" in rule_ids:
        rows = wrong_parent(rows, "parentcircuitsourceguid", network.own_parents, "_breakers")
        asked.append("if(_fed and _breakers > 0, 'R04', null)")
    if "R02" in rule_ids:
        asked.append(f"if(_phased and {PHASE} between 1 and 7, 'R02', null)")
    rows = rows.selectExpr("*", f"explode(array({', '.join(asked)})) as _rule").where("_rule is not null")
    if "R02" in rule_ids:
        # A full ABC transformer lacks no phase, and a feature without a phase code is never flagged.
        transformers = network["puestotransfdistribucion"].where(f"{PHASE} between 1 and 6")
        transformers = transformers.selectExpr(
            "circuitsourceguid as _source", f"{PHASE} as _transformer_phase", "alimentadorid as _transformer_feeder"
        )
        # R02 names the transformer's feeder: what a row does not need is not shuffled.
        own_feeder = "if(_rule = 'R02', null, alimentadorid) as alimentadorid"
        kept = [name for name in rows.columns if name not in ("alimentadorid", "parentcircuitsourceguid", "_phased", "_fed")]
        rows = rows.selectExpr(*kept, own_feeder, "if(_rule = 'R02', parentcircuitsourceguid, null) as _circuit")
        rows = spread_join(rows, transformers, "_circuit", "_source", "objectid")
        rows = rows.where(f"_rule = 'R04' or {phases_outside(PHASE, '_transformer_phase')}")
        feeder = "if(_rule = 'R02', _transformer_feeder, alimentadorid) as alimentadorid"
        rows = rows.selectExpr(*[c for c in rows.columns if c != "alimentadorid"], feeder)
        texts = [
            joined(literal(values.CLIENT_PHASE), phase_letters(PHASE)),
            joined(literal(values.TRANSFORMER_PHASE), phase_letters("_transformer_phase")),
        ]
        texts = [f"if(_rule = 'R02', {text}, null)" for text in texts]
    else:
        texts = [NO_TEXT, NO_TEXT]
    times = "if(_rule = 'R04', _breakers, 1L) as times" if "R04" in rule_ids else "1L as times"
    return marks(rows, "_rule", "_element", *texts, "globalid", "once", "_rule = 'R04' and private_only as private_only", times)


def per_connection(found: DataFrame, network: Network) -> DataFrame:
    """Marks with `copies`: for load points the number of their connections that count, 1 for other features.

    Where `private_only`, a connection of a public project, or of none, does not count.
    """
    private = f"count_if(proyectoconstruccion <> {literal(values.PUBLIC_PROJECT)})"
    totals = child_totals(network["conexionconsumidor"], "puntocargaglobalid", _all="count(1)", _private=private)
    counted = spread_join(found, totals, "globalid", "_child_key", "object_id")
    copies = "times * if(once, 1L, coalesce(if(private_only, _private, _all), 0L)) as copies"
    return counted.selectExpr(*[name for name in found.columns if name not in COUNTED], copies)


def hot_connections(network: Network, rule_ids: set[str]) -> bool:
    """Whether one mark of `per_connection` may be wanted very often."""
    times = network.own_parents.most if "R04" in rule_ids else 1
    return network.is_hot("conexionconsumidor", "puntocargaglobalid", times=times)


def hot_rows(network: Network, counted: tuple[str, str] | None) -> bool:
    """Whether one mark may be wanted very often, where copies count rows of a table by a key."""
    return counted is None or network.is_hot(*counted)


def repeated_code(rule_id: str, code: str, label: str, distinct: bool = False) -> Callable[[Network], DataFrame]:
    """Every connection of a repeated code, once per group of equal audit values and per account.

    `distinct` reports a connection once per group, however many accounts share the code.
    """

    def plan(network: Network) -> DataFrame:
        connections = network["conexionconsumidor"]
        points = network["puntocarga"].selectExpr("globalid as _point_key", "alimentadorid", "objectid as _point")
        groups = duplicate_key(connections, code, list(AUDIT)).withColumnRenamed(code, "_code")
        accounts = child_totals(network["atributosconsumidor"], code, _accounts="count(1)")
        groups = spread_join(groups, accounts, "_code", "_child_key", "_code", "inner")
        # Pairs of members and groups are many: they are made last, and not shuffled again. Members of a hot code go first
        # to their groups, straight from the scan, by whose many tasks AQE splits them.
        joins = [(points, "puntocargaglobalid", "_point_key"), (groups, code, "_code")]
        members = connections.select("objectid", "puntocargaglobalid", code)
        for right, key, right_key in reversed(joins) if network.is_hot("conexionconsumidor", code) else joins:
            members = inner_join(members, right, key, right_key)
        texts = joined(literal(f"{label} = "), code), joined("'ObjectIDPC = '", "_point")
        copies = "1L as copies" if distinct else "_accounts as copies"
        return marks(members, literal(rule_id), literal(CONNECTION), *texts, copies)

    return plan


def missing_key(rule_id: str, key: str, extra: str = "true") -> Callable[[Network], DataFrame]:
    def plan(network: Network) -> DataFrame:
        missing = rows_missing_key(network["conexionconsumidor"], key, extra)
        return summary_marks(missing, rule_id, CONNECTION, "objectid", records("total"), network.audit_date)

    return plan


# --- Registry -----------------------------------------------------------------------------------


@dataclass(frozen=True)
class Rule:
    """One rule. Rules with `scheduled` unset run only when named.

    `checks` judge the rows of views, `plan` gives marks, and rules that are `fed` are questions of `fed_marks`. The copies
    of a plan's marks count rows of the table and key `counted`, if named.
    """

    rule_id: str
    name: str
    checks: Callable[[Network], Checks] | None = None
    plan: Callable[[Network], DataFrame] | None = None
    fed: bool = False
    scheduled: bool = True
    heading: tuple[str, str] | None = None
    counted: tuple[str, str] | None = None

    @property
    def title(self) -> tuple[str, str]:
        """Category and title."""
        return self.heading or values.RULE_TITLES[self.rule_id]


_STATION, _CAPACITOR, _ACCOUNT = "puestotransfdistribucion", "puestocorrectorfactorpotencia", "atributosconsumidor"

RULES: dict[str, Rule] = {
    rule.rule_id: rule
    for rule in [
        Rule("R01", "phase_vs_subtype", phase_vs_subtype),
        Rule("R02", "feature_vs_transformer", fed=True),
        Rule("R03", "feeder_info", feeder_info),
        Rule("R04", "fed_by_breaker", fed=True),
        Rule("R05", "switch_structure", switch_structure),
        Rule("R06", "switch_units_vs_phase", units_vs_phase("R06", "fuse_switch_units", SWITCH)),
        Rule("R07", "fuse_capacity_missing", capacity_missing),
        Rule("R08", "capacitor_units_vs_phase", units_vs_phase("R08", "capacitor_units", CAPACITOR)),
        Rule("R09", "capacitor_unit_power", unit_power("R09", "capacitor_units", CAPACITOR, _CAPACITOR)),
        Rule("R10", "conductor_and_sequence", conductor_and_sequence),
        Rule("R11", "conductor_and_voltage", conductor_and_voltage),
        Rule("R12", "breaker_values_missing", breaker_values),
        Rule("R13", "taps_and_sides", taps_and_sides),
        Rule("R14", "units_vs_subtype", units_vs_subtype),
        Rule("R15", "station_vs_unit_phase", station_vs_unit_phase),
        Rule("R16", "bank_unit_phases", bank_phases),
        Rule("R17", "transformer_unit_power", unit_power("R17", "transformer_units", TRANSFORMER, _STATION)),
        Rule("R18", "client_code_repeated", plan=repeated_code("R18", "codigocliente", "CodigoCliente"), counted=(_ACCOUNT, "codigocliente")),
        Rule(
            "R19",
            "unique_code_repeated",
            plan=repeated_code("R19", "codigounico", "CodigoUnico"),
            scheduled=False,
            counted=(_ACCOUNT, "codigounico"),
        ),
        Rule("R20", "client_code_without_meter", no_meter),
        Rule("R21", "client_code_missing", no_client_code),
        Rule("R22", "client_code_and_meter_missing", plan=missing_key("R22", "codigocliente"), scheduled=False),
        Rule("R23", "unique_code_missing", plan=missing_key("R23", "codigounico", "novedades = 0"), scheduled=False),
    ]
}

BATCH: list[Rule] = [rule for rule in RULES.values() if rule.scheduled]


def shared_sources(network: Network, rule: Rule) -> set[str]:
    """What the rule reads that other rules may read in the same pass; the rule's own id if nothing."""
    views = {WIDER_VIEW.get(view, view) for view, _ in (rule.checks(network) if rule.checks else [])}
    return (views | ({"fed features"} if rule.fed else set())) or {rule.rule_id}


def rule_marks(network: Network, rules: Iterable[Rule]) -> DataFrame:
    """Marks of the rules, with one pass per view and one over the connections for all rules."""
    rules = list(rules)
    by_view: dict[str, list[Check]] = {}
    for rule in rules:
        for view, check in rule.checks(network) if rule.checks else []:
            by_view.setdefault(view, []).append(check)
    for narrow, wide in WIDER_VIEW.items():
        if narrow in by_view and wide in by_view:
            by_view[wide] = by_view.pop(narrow) + by_view[wide]
    parts = [(flag_rows(VIEWS[view](network), found), HOT_COPIES.get(view, unmeasured)) for view, found in by_view.items()]
    fed = {rule.rule_id for rule in rules if rule.fed}
    if fed:
        parts.append((per_connection(fed_marks(network, fed), network), partial(hot_connections, rule_ids=fed)))
    parts += [(rule.plan(network), partial(hot_rows, counted=rule.counted)) for rule in rules if rule.plan]
    plain = [part for part, _ in parts if "copies" not in part.columns]
    repeated: dict[bool, list[DataFrame]] = {}
    for part, hot in parts:
        if "copies" in part.columns:
            repeated.setdefault(hot(network), []).append(part)
    for hot, found in sorted(repeated.items()):
        plain.append(repeat_rows(reduce(DataFrame.unionByName, found), "copies", "object_id", hot))
    return reduce(DataFrame.union, [part.select(MARKS) for part in plain])


def findings_with_rule(network: Network, rules: Sequence[Rule], run_date: date) -> DataFrame:
    """Findings of the rules, with a leading `rule_id`."""
    titles = {rule.rule_id: rule.title for rule in rules}
    return as_findings(rule_marks(network, rules), titles, network.feeders, run_date, network.audit_date)


def rule_findings(network: Network, rule: Rule | str, run_date: date) -> DataFrame:
    """The findings of one rule, in the findings schema."""
    rule = RULES[rule] if isinstance(rule, str) else rule
    return findings_with_rule(network, [rule], run_date).select(COLUMNS)

"""The registered queries once more as SQL for DuckDB, written apart from the Spark plans.

Each rule is a SELECT of its marks over the adapter views; `findings_sql` adds title and feeder.
"""

from __future__ import annotations

from collections.abc import Iterable

from gridwarden.functions import values as v
from gridwarden.sources.star import ADAPTERS, ARCHIVE, BESIDE, CATALOG, LAYER_COLUMN

RUN_DATE = "2015-04-02"

# One row per phase code: phases, letters.
_PHASE = (
    "select * from (values (1, 1, 'C'), (2, 1, 'B'), (3, 2, 'BC'), (4, 1, 'A'), (5, 2, 'AC'), (6, 2, 'AB'), (7, 3, 'ABC')) "
    "t(code, n, letters)"
)
_SUBTYPE = " union all ".join(
    f"select '{kind}' kind, {subtype} subtype, {n} n"
    for kind, table in [("MT", v.MEDIUM_VOLTAGE_PHASES), ("BT", v.LOW_VOLTAGE_PHASES), ("TR", v.TRANSFORMER_PHASES)]
    for subtype, n in table.items()
)
_GROUP = " union all ".join(
    f"select {subtype} subtype, '{name}' label, {v.TRANSFORMER_UNITS[subtype]} required"
    for subtype, name in v.TRANSFORMER_GROUP.items()
)
# An empty text is a missing value.
_NO_EMPTY = {
    **dict.fromkeys(
        ("tramodistribucionaereo", "tramodistribucionsubterraneo"),
        "* replace (nullif(codigoconductorfase, '') as codigoconductorfase)",
    ),
    "unidadfusible": "* replace (nullif(capacidad, '') as capacidad)",
    "unidadcapacitor": "* replace (nullif(potencianominal, '') as potencianominal)",
    "puestoprotecciondinamico": "* replace (nullif(corriente, '') as corriente)",
    "conexionconsumidor": "* replace (nullif(codigocliente, '') as codigocliente, nullif(codigounico, '') as codigounico)",
    "atributosconsumidor": "* replace (nullif(nummedidor, '') as nummedidor)",
}
_CTES = {
    **{f"raw_{name}": adapter.sql for name, adapter in ADAPTERS.items()},
    **{name: f"select {_NO_EMPTY.get(name, '*')} from raw_{name}" for name in ADAPTERS},
    **CATALOG,
    "phase": _PHASE,
    "subtype_phases": _SUBTYPE,
    "transformer_group": _GROUP,
    "unit_totals": (
        "select puestotransfdistglobalid station, count(*) n, sum(coalesce(faseconexion, 0)) phases, "
        "sum(coalesce(potencianominal, 0)) power from unidadtransfdistribucion group by all"
    ),
    "own_parent": (
        "select circuitsourceguid source from puestoprotecciondinamico where circuitsourceguid = parentcircuitsourceguid"
    ),
}


def _stamp(alias: str) -> str:
    return (
        f"{alias}.usuarioregistro created_by, {alias}.fecharegistro created_at, "
        f"{alias}.usuariomodificacionregistro modified_by, {alias}.fechamodificacionregistro modified_at"
    )


def _mark(alias: str, element: str, detail_1: str = "null::varchar", detail_2: str = "null::varchar", feeder: str = "") -> str:
    return (
        f"select {feeder or alias + '.alimentadorid'} feeder_id, {element} element, {alias}.objectid object_id, "
        f"{detail_1} detail_1, {detail_2} detail_2, {_stamp(alias)}"
    )


def _summary(element: str, object_id: str, detail_1: str, detail_2: str = "null::varchar") -> str:
    return (
        f"select null::varchar feeder_id, '{element}' element, {object_id} object_id, {detail_1} detail_1, "
        f"{detail_2} detail_2, null::varchar created_by, null::date created_at, null::varchar modified_by, "
        "null::date modified_at"
    )


def _number(value: str) -> str:
    return f"regexp_replace(cast(cast(round({value}, 2) as decimal(38, 2)) as varchar), '[.]?0+$', '')"


def _union(parts: Iterable[str]) -> str:
    return " union all ".join(parts)


_R01 = _union(
    _mark("s", f"'{element}'", f"'{v.COUNT_BY_PHASE}' || coalesce(p.n, 0)", f"'{v.COUNT_BY_SUBTYPE}' || t.n")
    + f" from {table} s join subtype_phases t on t.kind = '{kind}' and t.subtype = s.subtipo "
    "left join phase p on p.code = s.faseconexion where t.n <> coalesce(p.n, 0)"
    for table, element, kind in [
        ("tramodistribucionaereo", "MTA", "MT"),
        ("tramodistribucionsubterraneo", "MTS", "MT"),
        ("tramobajatensionaereo", "BTA", "BT"),
        ("tramobajatensionsubterraneo", "BTS", "BT"),
        ("puestotransfdistribucion", "Transformadores", "TR"),
    ]
)

_R02 = _union(
    _mark("d", f"'{element}'", f"'{v.CLIENT_PHASE}' || cp.letters", f"'{v.TRANSFORMER_PHASE}' || tp.letters", "s.alimentadorid")
    + f" from {table} d {extra} join phase cp on cp.code = d.faseconexion "
    "join puestotransfdistribucion s on s.circuitsourceguid = d.parentcircuitsourceguid "
    "join phase tp on tp.code = s.faseconexion "
    "where regexp_replace(cp.letters, '[' || tp.letters || ']', '', 'g') <> ''"
    for table, element, extra in [
        ("puntocarga", "Punto Carga", "join conexionconsumidor c on c.puntocargaglobalid = d.globalid"),
        ("luminaria", "Luminaria", ""),
    ]
)

# The expected feeder code is the phase mask read backwards.
_MIRROR = "(((s.faseconexion & 1) << 2) | (s.faseconexion & 2) | (s.faseconexion >> 2))"
_R03 = _union(
    _mark(
        "s",
        f"'{element}'",
        f"concat('Fase=', p.letters, ' AlimentadorInfo esperado=', case when p.code is not null then {_MIRROR} end, "
        "' actual=', s.alimentadorinfo)",
    )
    + f" from {table} s left join phase p on p.code = s.faseconexion where s.faseconexion is not null {extra}"
    f"and (s.alimentadorinfo is null or (p.code is not null and s.alimentadorinfo <> {_MIRROR}))"
    for table, element, extra in [
        ("tramobajatensionaereo", "Tramo Baja Aereo", ""),
        ("tramobajatensionsubterraneo", "Tramo Baja Subterraneo", ""),
        ("tramodistribucionaereo", "Tramo Distribución Aereo", ""),
        ("tramodistribucionsubterraneo", "Tramo Distribución Subterraneo", ""),
        ("luminaria", "Luminaria", ""),
        ("puestotransfdistribucion", "Transformador", ""),
        ("puestoseccionadorfusible", "Seccionador Fusible", ""),
        ("puntocarga", "Punto Carga", "and s.subtipo <> 1 "),
    ]
)

_R04 = _union(
    _mark("s", f"'{element}'") + f" from {table} s join own_parent o on o.source = s.parentcircuitsourceguid {extra}"
    for table, element, extra in [
        ("tramobajatensionaereo", "Tramo Baja Aereo", ""),
        ("tramobajatensionsubterraneo", "Tramo Baja Subterraneo", ""),
        (
            "puntocarga",
            "Punto Carga",
            "join conexionconsumidor c on c.puntocargaglobalid = s.globalid where s.subtipo <> 6 "
            "and (s.subtipo <> 1 or c.proyectoconstruccion <> 'FOPE')",
        ),
        ("luminaria", "Luminaria", ""),
    ]
)

_VOLTAGE = (
    f"case when g.n = 1 and g.voltaje <> 7960 then '{v.VOLTAGE_SINGLE}' "
    f"when g.n > 1 and g.voltaje <> 13800 then '{v.VOLTAGE_MULTI}' end"
)


def _pick(subject: str, texts: dict[int, str]) -> str:
    return f"case {subject} " + " ".join(f"when {key} then '{text}'" for key, text in texts.items()) + " end"


_R05 = (
    _mark("g", "'Seccionador Fusible'", "concat(g.a, ';', g.b)", "concat(g.c, ';', g.d)")
    + f" from (select g.*, {_VOLTAGE} a, "
    f"case when g.digit <> cast(g.n as varchar) then {_pick('g.n', v.STRUCTURE_PHASES)} end b, "
    f"case when g.letter <> substr('SDE', g.subtipo, 1) then {_pick('g.subtipo', v.STRUCTURE_SUBTYPE)} end c, "
    f"case when g.amps <> trim(g.corriente) then {_pick('g.subtipo', v.STRUCTURE_CURRENT)} end d "
    "from (select s.*, p.n, nullif(k.descripcioncorta[1:1], '') digit, nullif(k.descripcioncorta[2:2], '') letter, "
    "nullif(trim(k.descripcioncorta[3:5]), '') amps from puestoseccionadorfusible s "
    "left join phase p on p.code = s.faseconexion "
    "left join catalogoestructura k on k.codigoestructura = s.codigoestructura) g) g "
    "where coalesce(g.a, g.b, g.c, g.d) is not null"
)


def _unit_count(parent: str, child: str, key: str, element: str) -> str:
    count = f"(select count(*) from {child} u where u.{key} = s.globalid)"
    return (
        _mark("g", f"'{element}'", f"'{v.COUNT_BY_PHASE}' || g.n", f"'{v.COUNT_OF_UNITS}' || g.units")
        + f" from (select s.*, p.n, {count} units from {parent} s join phase p on p.code = s.faseconexion) g where g.n <> g.units"
    )


def _unit_power(parent: str, child: str, key: str, element: str, power: str) -> str:
    unread = f"select count(*) from {child} u where u.{key} = s.globalid and u.potencianominal is not null and {power} is null"
    return (
        _mark(
            "g",
            f"'{element}'",
            f"concat('{v.POWER_DIFFERS}. Puesto = ', {_number('g.own')}, ' Unidad = ', {_number('g.units')})",
            "case when g.unread > 0 then 'Potencias no legibles = ' || g.unread end",
        )
        + f" from (select s.*, s.potenciakva own, coalesce((select sum(coalesce({power}, 0)) from {child} u "
        f"where u.{key} = s.globalid), 0) units, ({unread}) unread from {parent} s) g "
        "where g.own is not null and (g.unread > 0 or round(g.own, 2) <> round(g.units, 2))"
    )


_R06 = _unit_count("puestoseccionadorfusible", "unidadfusible", "puestosecfusibleglobalid", "Seccionador Fusible")
_R07 = (
    _mark("s", "'Seccionador Fusible'", f"'{v.CAPACITY_MISSING}'")
    + " from unidadfusible u join puestoseccionadorfusible s on s.globalid = u.puestosecfusibleglobalid "
    "where u.capacidad is null"
)
_R08 = _unit_count("puestocorrectorfactorpotencia", "unidadcapacitor", "puestocorrfacpotglobalid", "Capacitor")
_R09 = _unit_power(
    "puestocorrectorfactorpotencia",
    "unidadcapacitor",
    "puestocorrfacpotglobalid",
    "Capacitor",
    "try_cast(replace(u.potencianominal, ',', '.') as decimal(28, 10))",
)
_R10 = _union(
    _mark("s", f"'{element}'", f"'{text}'") + f" from {table} s {condition}"
    for table, element in [("tramodistribucionaereo", "TMA"), ("tramodistribucionsubterraneo", "TMS")]
    for text, condition in [
        (
            v.CONDUCTOR_MISSING,
            "where (s.codigoconductorfase || s.configuracionconductores || s.secuenciafase) is null",
        ),
        (
            v.SEQUENCE_OUTSIDE,
            "join phase p on p.code = s.faseconexion where regexp_matches(s.secuenciafase, '[^' || p.letters || ' ]')",
        ),
    ]
)
_R11 = _union(
    _mark("g", f"'{element}'", "g.a", "concat(g.b, ';', g.c)")
    + f" from (select g.*, {_VOLTAGE} a, "
    f"case when g.n > 0 and g.configuracionconductores[1:1] <> cast(g.n as varchar) then {_pick('g.n', v.LAYOUT_PHASES)} end b, "
    f"case when g.codigoconductorneutro = '{v.NO_NEUTRAL}' then case when g.wires <> g.n then '{v.LAYOUT_NO_NEUTRAL}' end "
    f"when g.wires <= g.n then '{v.LAYOUT_NEUTRAL}' end c "
    "from (select s.*, coalesce(p.n, 0) n, try_cast(nullif(s.configuracionconductores[2:2], '') as int) wires "
    f"from {table} s left join phase p on p.code = s.faseconexion where s.codigoconductorfase is not null "
    "and s.codigoconductorneutro is not null and s.faseconexion is not null "
    "and s.configuracionconductores is not null) g) g where coalesce(g.a, g.b, g.c) is not null"
    for table, element in [("tramodistribucionaereo", "MTA"), ("tramodistribucionsubterraneo", "MTS")]
)


def _if_null(column: str, text: str) -> str:
    return f"case when s.{column} is null then '{text}' end"


_R12 = (
    _mark(
        "s",
        "'Puesto Proteccion Dinámico'",
        f"concat({_if_null('corriente', v.CURRENT_MISSING)}, ';', {_if_null('corrientemaxcortocircuito', v.SHORT_CIRCUIT_MISSING)})",
        f"concat({_if_null('faseconexion', v.PHASE_MISSING)}, ';', {_if_null('voltaje', v.VOLTAGE_MISSING)})",
    )
    + " from puestoprotecciondinamico s where (s.corriente is null or s.corrientemaxcortocircuito is null or s.faseconexion is null or s.voltaje is null)"
)
_R13 = _union(
    _mark("s", "'Puesto Transformador'", f"'{text}'")
    + " from unidadtransfdistribucion u join puestotransfdistribucion s on s.globalid = u.puestotransfdistglobalid "
    f"where {condition}"
    for text, condition in [
        (v.TAP_INVALID, "coalesce(u.tapnormal, 0) not between 1 and 5"),
        (v.SIDE_MISSING, "(s.configuracionladobaja + s.configuracionladomedia) is null"),
    ]
)
_R14 = (
    _mark(
        "s",
        "'Puesto Transformador'",
        "g.label || ' creado con ' || u.n || ' unidad(es)'",
        "'Debe tener ' || g.required || ' unidad(es)'",
    )
    + " from puestotransfdistribucion s join transformer_group g on g.subtype = s.subtipo "
    "join unit_totals u on u.station = s.globalid where u.n <> g.required"
)
_R15 = (
    _mark(
        "s",
        "'Puesto Transformador'",
        "concat(g.label, ' no coinciden Fase de Conexión, Puesto=', "
        f"case when coalesce(s.faseconexion, 0) = 0 then '{v.NULL_PHASE}' else sp.letters end, '  Unidad=', "
        f"case when coalesce(u.phases, 0) = 0 then '{v.NULL_PHASE}' else coalesce(up.letters, '{v.UNKNOWN_PHASE}') end)",
        f"case when sp.n = 1 and u.n > 1 then '{v.PARALLEL_NOTE}' end",
    )
    + " from puestotransfdistribucion s left join transformer_group g on g.subtype = s.subtipo "
    "left join unit_totals u on u.station = s.globalid left join phase sp on sp.code = s.faseconexion "
    "left join phase up on up.code = u.phases "
    "where coalesce(s.faseconexion, 0) = 0 or s.faseconexion <> coalesce(u.phases, 0)"
)
_R16 = (
    _mark(
        "s",
        "'Puesto Transformador'",
        "concat(g.label, ' tiene Fase Conexion = ', sp.letters)",
        f"concat('Fase ', up.letters, ' se repite en la unidad ', u.repeats, ' veces;{v.PARALLEL_NOTE}')",
    )
    + " from (select puestotransfdistglobalid station, faseconexion code, count(*) repeats "
    "from unidadtransfdistribucion group by all having count(*) > 1) u "
    "join puestotransfdistribucion s on s.globalid = u.station and s.subtipo between 9 and 12 "
    "join transformer_group g on g.subtype = s.subtipo left join phase sp on sp.code = s.faseconexion "
    "left join phase up on up.code = u.code"
)
_R17 = _unit_power(
    "puestotransfdistribucion",
    "unidadtransfdistribucion",
    "puestotransfdistglobalid",
    "Puesto Transformador",
    "u.potencianominal",
)


def _repeated(code: str, label: str) -> str:
    return (
        f"select p.alimentadorid feeder_id, 'Conexion Consumidor' element, c.objectid object_id, '{label} = ' || c.{code} "
        f"detail_1, 'ObjectIDPC = ' || p.objectid detail_2, {_stamp('z')} "
        f"from (select distinct {code}, usuarioregistro, fecharegistro, usuariomodificacionregistro, fechamodificacionregistro "
        f"from (select *, count(*) over (partition by {code}, usuarioregistro, fecharegistro, usuariomodificacionregistro, "
        f"fechamodificacionregistro) copies from conexionconsumidor) where copies > 1 and {code} is not null) z "
        f"join conexionconsumidor c on c.{code} = z.{code} join puntocarga p on p.globalid = c.puntocargaglobalid "
        f"join atributosconsumidor a on a.{code} = c.{code}"
    )


_R18 = _repeated("codigocliente", "CodigoCliente")
_R19 = _repeated("codigounico", "CodigoUnico")
_R20 = (
    _summary(
        "Conexion Consumidor",
        "0::bigint",
        "concat('Existen ', total, ' registros')",
        "concat('Activos=', a, '  Gestion Comercial=', b, '  Inactivo=', w)",
    )
    + " from (select nullif(count(*), 0) total, case when count(*) > 0 then count(*) filter (edccod = 'A') end a, "
    "case when count(*) > 0 then count(*) filter (edccod = '1') end b, "
    "case when count(*) > 0 then count(*) filter (edccod = 'W') end w "
    "from conexionconsumidor join atributosconsumidor using (codigocliente) where nummedidor is null)"
)
_R21 = (
    _summary("Conexion Consumidor", "0::bigint", "'Existen ' || count(*) || ' registros'")
    + " from conexionconsumidor where codigocliente is null"
)
_R22 = (
    _summary("Conexion Consumidor", "objectid", "'Existen ' || count(*) || ' registros'")
    + " from conexionconsumidor where codigocliente is null group by objectid"
)
_R23 = (
    _summary("Conexion Consumidor", "objectid", "'Existen ' || count(*) || ' registros'")
    + " from conexionconsumidor where codigounico is null and novedades = 0 group by objectid"
)

MARKS = {
    "R01": _R01, "R02": _R02, "R03": _R03, "R04": _R04, "R05": _R05, "R06": _R06, "R07": _R07, "R08": _R08,
    "R09": _R09, "R10": _R10, "R11": _R11, "R12": _R12, "R13": _R13, "R14": _R14, "R15": _R15, "R16": _R16,
    "R17": _R17, "R18": _R18, "R19": _R19, "R20": _R20, "R21": _R21, "R22": _R22, "R23": _R23,
}


def with_ctes(sql: str) -> str:
    """The query behind the adapter views it can use."""
    return "with " + ", ".join(f"{name} as ({cte})" for name, cte in _CTES.items()) + " " + sql


def run_row(category: str, rule: str, detail_1: str, detail_2: str | None = None) -> str:
    """One row about the run itself."""
    second = f"'{detail_2}'" if detail_2 else "null::varchar"
    return (
        f"select '{category}' category, '{rule}' rule, null::varchar feeder_id, null::varchar feeder_name, ' ' element, "
        f"0::bigint object_id, '{detail_1}' detail_1, {second} detail_2, date '{RUN_DATE}' run_date, "
        "null::varchar created_by, null::date created_at, null::varchar modified_by, null::date modified_at"
    )


# Code columns as texts for the query `unreadable_values`, and which rows hold a text that is no code there.
TEXT_CODES = {
    "puestocorrectorfactorpotencia": {
        "faseconexion": "case when objectid % 10 = 0 then '2.5' when objectid % 11 = 0 then '1A' when objectid % 13 = 0 then '' "
        "else cast(faseconexion as string) end"
    },
    "puestotransfdistribucion": {
        "faseconexion": "cast(faseconexion as string)",
        "subtipo": "case when objectid % 7 = 0 then 'x' else cast(subtipo as string) end",
    },
}
NO_CODES = {
    ("puestocorrectorfactorpotencia", "faseconexion"): "objectid % 10 = 0 or objectid % 11 = 0",
    ("puestotransfdistribucion", "subtipo"): "objectid % 7 = 0",
}


def unreadable_sql() -> str:
    """One ERROR row per column that holds values without a code."""
    return with_ctes(
        _union(
            f"select * replace ('{v.UNREADABLE_VALUES}' || (select count(*) from {table} where {no_code}) as rule) "
            f"from ({run_row('ERROR', '', v.UNREADABLE_TABLE + table, v.UNREADABLE_COLUMN + column)}) "
            f"where exists (select 1 from {table} where {no_code})"
            for (table, column), no_code in NO_CODES.items()
        )
    )


def findings_body(rule_ids: Iterable[str]) -> str:
    """Findings of the rules, without the views."""
    return _union(
        f"select '{v.RULE_TITLES[r][0]}' category, '{v.RULE_TITLES[r][1]}' rule, m.feeder_id, f.descripcion feeder_name, "
        f"m.element, m.object_id, m.detail_1, m.detail_2, date '{RUN_DATE}' run_date, m.created_by, m.created_at, "
        f"m.modified_by, m.modified_at from ({MARKS[r]}) m left join alimentador f on f.alimentadorid = m.feeder_id"
        for r in rule_ids
    )


def findings_sql(rule_ids: Iterable[str]) -> str:
    return with_ctes(findings_body(rule_ids))


def census_sql() -> str:
    """Layers picked by set operations, then counted."""
    counted = _union(
        f"select '{table.upper()}' feat, count(ordentrabajo) ots from {table}"
        for table in ("puestotransfdistribucion", "puestoseccionadorfusible", "luminaria")
    )
    picked = (
        "select table_name from fx_columns where column_name = 'ORDENTRABAJO' group by table_name "
        "having count(*) = 1 and max(owner) = 'SIGELEC'"
    )
    return with_ctes(
        f"select feat, ots from ({counted}) where feat in ({picked}) and feat in (select table_name from fx_layers) "
        "and not regexp_matches(feat, '^[AD|][0-9]')"
    )


def selection_sql() -> str:
    """Layers picked from the described columns of the network's tables and of those beside them."""
    own = {table: table for table in ADAPTERS} | BESIDE
    columns = _union(
        f"select '{owner}' owner, '{name.upper()}' table_name, upper(column_name) column_name "
        f"from (describe {ADAPTERS[table].sql})"
        for owner, tables in (("network", own), ("archive", ARCHIVE))
        for name, table in tables.items()
    )
    return (
        f"with columns as ({columns}) select table_name from columns where column_name = 'ORDENTRABAJO' "
        f"and table_name in (select table_name from columns where column_name = '{LAYER_COLUMN}') "
        "and not regexp_matches(table_name, '^[AD|][0-9]') group by table_name "
        "having count(*) = 1 and max(owner) = 'network'"
    )


def lasting_census_sql() -> str:
    """Filled values per picked layer, over all tables that have the column."""
    counted = _union(
        f"select '{name.upper()}' feat, count(ordentrabajo) ots from ({ADAPTERS[name].sql})"
        for name, adapter in ADAPTERS.items()
        if any(column.endswith(" ordentrabajo") for column in adapter.columns)
    )
    return f"select feat, ots from ({counted}) where feat in ({selection_sql()})"

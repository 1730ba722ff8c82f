"""The network's tables: declared columns, readers, and facts about the small lookups."""

from __future__ import annotations

import re
from collections.abc import Callable, Mapping, Sequence
from functools import cache, cached_property
from threading import Thread

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from gridwarden.operators.joins import Lookup, is_hot, most_rows

#: How long counts of a finished job may take to arrive.
TRACE_SECONDS = 10

# Column kinds: long and string are cast; number and as_is keep the source's numeric type, and a number's text becomes
# a decimal; audit_date is the network's. An empty text is NULL, as in the source of the rules.
AUDIT = {
    "usuarioregistro": "string",
    "fecharegistro": "audit_date",
    "usuariomodificacionregistro": "string",
    "fechamodificacionregistro": "audit_date",
}
FEATURE = {"objectid": "long", "alimentadorid": "string", "faseconexion": "long", **AUDIT}
LAYER = {**FEATURE, "alimentadorinfo": "long", "subtipo": "long"}
MEDIUM_SPAN = {
    **LAYER,
    "voltaje": "number",
    "codigoconductorfase": "string",
    "codigoconductorneutro": "string",
    "configuracionconductores": "string",
    "secuenciafase": "string",
}
LOW_SPAN = {**LAYER, "parentcircuitsourceguid": "string"}

TABLES: dict[str, dict[str, str]] = {
    "tramodistribucionaereo": MEDIUM_SPAN,
    "tramodistribucionsubterraneo": MEDIUM_SPAN,
    "tramobajatensionaereo": LOW_SPAN,
    "tramobajatensionsubterraneo": LOW_SPAN,
    "puestotransfdistribucion": {
        **LAYER,
        "globalid": "string",
        "circuitsourceguid": "string",
        "potenciakva": "as_is",
        "configuracionladobaja": "as_is",
        "configuracionladomedia": "as_is",
    },
    "unidadtransfdistribucion": {
        "objectid": "long",
        "puestotransfdistglobalid": "string",
        "faseconexion": "long",
        "tapnormal": "number",
        "potencianominal": "as_is",
    },
    "puestoseccionadorfusible": {
        **LAYER,
        "globalid": "string",
        "voltaje": "number",
        "corriente": "as_is",
        "codigoestructura": "string",
    },
    "unidadfusible": {"objectid": "long", "puestosecfusibleglobalid": "string", "capacidad": "as_is"},
    "puestocorrectorfactorpotencia": {**FEATURE, "globalid": "string", "potenciakva": "as_is"},
    "unidadcapacitor": {"objectid": "long", "puestocorrfacpotglobalid": "string", "potencianominal": "as_is"},
    "puestoprotecciondinamico": {
        **FEATURE,
        "circuitsourceguid": "string",
        "parentcircuitsourceguid": "string",
        "corriente": "as_is",
        "corrientemaxcortocircuito": "as_is",
        "voltaje": "number",
    },
    "puntocarga": {**LAYER, "globalid": "string", "parentcircuitsourceguid": "string"},
    "conexionconsumidor": {
        "objectid": "long",
        "puntocargaglobalid": "string",
        "codigocliente": "string",
        "codigounico": "string",
        "novedades": "number",
        "proyectoconstruccion": "string",
        **AUDIT,
    },
    "atributosconsumidor": {
        "codigocliente": "string",
        "codigounico": "string",
        "nummedidor": "string",
        "edccod": "string",
    },
    "luminaria": {**FEATURE, "alimentadorinfo": "long", "parentcircuitsourceguid": "string"},
    "catalogoestructura": {"codigoestructura": "string", "descripcioncorta": "string"},
    "alimentador": {"alimentadorid": "string", "descripcion": "string"},
}


class Network:
    """The tables of one network, each with its declared columns and types.

    `load` gives a table by its name and is asked only for the tables that a rule needs, so a rule
    fails only if a table of its own is missing. `audit_date` is `date` or `timestamp`: what the
    audit columns hold.
    """

    def __init__(self, load: Callable[[str], DataFrame], audit_date: str = "date"):
        self.load = cache(load)
        self.audit_date = audit_date
        self._tables: dict[str, DataFrame] = {}
        self._traces: dict[str, Observation] | None = None
        self._most: dict[tuple[str, str, bool], tuple[int, int]] = {}
        self._strange: dict[tuple[str, str, tuple[int, ...]], bool] = {}

    def traced(self) -> Network:
        """The same network, which counts the values that cannot be read while jobs scan its tables; see `unreadable`."""
        network = Network(self.load, self.audit_date)
        network._traces = {}
        return network

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._tables:
            frame = self.declared(name)
            lost = self._lost_values(name) if self._traces is not None else {}
            if lost:
                trace = self._traces[name] = Observation(f"unreadable {name}")
                counted = [F.expr(f"count_if({condition})").alias(column) for column, condition in lost.items()]
                frame = self._cast(name, self.load(name).observe(trace, *counted))
            self._tables[name] = frame
        return self._tables[name]

    def declared(self, name: str) -> DataFrame:
        """A table without a trace, for what scans a part of it only."""
        return self._cast(name, self.load(name))

    def is_hot(self, name: str, key: str, nulls: bool = False, times: int = 1) -> bool:
        """Whether one key, or NULL with `nulls`, may have so many rows of the table, `times` over, that they are more
        than one task should do. Measured once, without a trace."""
        if (name, key, nulls) not in self._most:
            rows = self.declared(name).select(key)
            self._most[name, key, nulls] = most_rows(rows if nulls else rows.where(F.col(key).isNotNull()), key)
        most, total = self._most[name, key, nulls]
        return is_hot(most * times, total)

    def holds_only(self, name: str, column: str, codes: Sequence[int]) -> bool:
        """Whether the column holds these codes and NULL only. Looked up once, without a trace."""
        asked = name, column, tuple(codes)
        if asked not in self._strange:
            self._strange[asked] = not self.declared(name).where(~F.col(column).isin(list(codes))).isEmpty()
        return not self._strange[asked]

    def _cast(self, name: str, frame: DataFrame) -> DataFrame:
        types = self._types(name)
        return frame.selectExpr(*[self._column(name, c, k, types) for c, k in TABLES[name].items()])

    def _types(self, name: str) -> dict[str, str]:
        return {f.name.lower(): f.dataType.simpleString() for f in self.load(name).schema}

    def _lost_values(self, name: str) -> dict[str, str]:
        """Per column whose values are converted, which rows hold a value that turns NULL."""
        types, lost = self._types(name), {}
        for column, kind in TABLES[name].items():
            read = self._column(name, column, kind, types).removesuffix(f" as {column}")
            held = f"nullif({column}, '')" if types[column] == "string" else column
            if kind == "audit_date" and types[column] == "string":
                read = f"try_cast({held} as timestamp)"
            if read.startswith("try_cast("):
                lost[column] = f"{held} is not null and {read} is null"
        return lost

    def unreadable(self) -> list[tuple[str, str, int]]:
        """(table, column, rows) of the values that could not be read, of the traced tables that jobs have scanned.

        The counts come with the jobs' own results; nothing is scanned for them. A table that no job has finished
        scanning has none, which shows by waiting in vain.
        """
        found = []
        for name, trace in sorted((self._traces or {}).items()):
            counts: dict[str, int] = {}
            waiting = Thread(target=lambda trace=trace, counts=counts: counts.update(trace.get), daemon=True)
            waiting.start()
            waiting.join(TRACE_SECONDS)
            found += [(name, column, rows) for column, rows in sorted(counts.items()) if rows]
        return found

    def _column(self, table: str, name: str, kind: str, types: Mapping[str, str]) -> str:
        if name not in types:
            raise ValueError(f"table {table} has no column {name}")
        target = {"long": "bigint", "number": "decimal(28,10)", "audit_date": self.audit_date}.get(kind, kind)
        is_text = types[name] == "string"
        held = f"nullif({name}, '')" if is_text else name
        if kind == "as_is" or (kind == "number" and not is_text):
            return f"{held} as {name}"
        if kind == "long" and (types[name] in ("float", "double") or re.fullmatch(r"decimal\(\d+,[1-9]\d*\)", types[name])):
            raise ValueError(f"{table}.{name} is a code, but its type {types[name]} can hold fractions")
        if kind == "audit_date" and target == "date":
            message = f"{table}.{name} holds times of day: read the network with audit_date='timestamp'"
            if types[name].startswith("timestamp"):
                raise ValueError(message)
            if is_text:
                at = f"try_cast({held} as timestamp)"
                return f"if({at} <> date_trunc('day', {at}), cast(raise_error('{message.replace(chr(39), '')}') as date), cast({at} as date)) as {name}"
        return f"{held} as {name}" if types[name] == target else f"try_cast({held} as {target}) as {name}"

    @cached_property
    def feeders(self) -> Lookup:
        return Lookup(self.declared("alimentador"), "alimentadorid", "descripcion")

    @cached_property
    def own_parents(self) -> Lookup:
        """The circuits whose breaker names its own circuit as its parent."""
        breakers = self.declared("puestoprotecciondinamico").where("circuitsourceguid = parentcircuitsourceguid")
        return Lookup(breakers, "circuitsourceguid", "objectid")

    @cached_property
    def structures(self) -> Lookup:
        return Lookup(self.declared("catalogoestructura"), "codigoestructura", "descripcioncorta")


def network_of(frames: Mapping[str, DataFrame], audit_date: str = "date") -> Network:
    """A network of given DataFrames."""
    known = {name.lower(): frame for name, frame in frames.items()}

    def load(name: str) -> DataFrame:
        if name not in known:
            raise ValueError(f"table {name} is not in the network")
        return known[name]

    return Network(load, audit_date)


def read_network(spark: SparkSession, location: str, fmt: str = "parquet", audit_date: str = "date", **options: str) -> Network:
    """A network whose tables lie in `<location>/<table>`, in any format that Spark reads."""
    return Network(lambda name: spark.read.format(fmt).options(**options).load(f"{location}/{name}"), audit_date)


def read_network_tables(spark: SparkSession, database: str, audit_date: str = "date") -> Network:
    """A network whose tables are catalog tables or views of `database`."""
    return Network(lambda name: spark.table(f"{database}.{name}"), audit_date)

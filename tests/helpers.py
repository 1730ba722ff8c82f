"""Small hand-made networks."""

from datetime import date

from gridwarden import network_of, rule_findings
from gridwarden.sources.network import TABLES

RUN_DATE = date(2015, 4, 2)
KINDS = {"long": "bigint", "string": "string", "audit_date": "date"}
AS_IS = {"potenciakva": "decimal(18,3)", "potencianominal": "decimal(18,3)", "corriente": "string"}


def table(spark, name, rows, **types):
    """A table with all of its columns; a row names only those that matter."""
    columns = {
        column: types.get(column) or KINDS.get(kind) or AS_IS.get(column, "bigint") for column, kind in TABLES[name].items()
    }
    schema = ", ".join(f"{column} {kind}" for column, kind in columns.items())
    return spark.createDataFrame([tuple(row.get(c) for c in columns) for row in rows], schema)


def network(spark, **tables):
    frames = {name: rows if hasattr(rows, "columns") else table(spark, name, rows) for name, rows in tables.items()}
    frames.setdefault("alimentador", table(spark, "alimentador", [{"alimentadorid": "1", "descripcion": "Norte"}]))
    return network_of(frames)


def found(net, rule_id, *columns):
    """The rule's findings as sorted tuples of the columns, object id first."""
    rows = rule_findings(net, rule_id, RUN_DATE).select("object_id", *columns).collect()
    return sorted((tuple(row) for row in rows), key=str)

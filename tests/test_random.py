"""All 23 rules against their SQL on random networks full of NULLs, unknown codes and repeated keys."""

import random
from collections import Counter
from datetime import date
from decimal import Decimal

import duckdb
import pytest
from helpers import AS_IS, KINDS, RUN_DATE, network, table

import gridwarden_oracle as oracle
from gridwarden import RULES
from gridwarden.operators import joins
from gridwarden.operators.findings import COLUMNS
from gridwarden.plans.rules import findings_with_rule
from gridwarden.sources.network import TABLES

KEYS = [None, "K1", "K2", "K3", "K4", "K5", "K6"]
POWERS = [None, "0", "12.5", "12.505", "25"]
DOMAINS = {
    "alimentadorid": [None, "1", "2", "3"],
    "faseconexion": [None, *range(-1, 10)],
    "alimentadorinfo": [None, *range(0, 10)],
    "subtipo": [None, *range(-1, 16)],
    "voltaje": [None, 0, 7960, 13800],
    "codigoconductorfase": [None, "E1", "E2"],
    "codigoconductorneutro": [None, "E1", "COO0000"],
    "configuracionconductores": [None, "1", "11", "12", "22", "23", "33", "34", "1x", "x"],
    "secuenciafase": [None, "A", "B", "AB", "CBA", " A ", "AX", "a", ""],
    "codigoestructura": [None, "E1", "E2", "E3", "E4"],
    "corriente": [None, "100", " 100", "200"],
    "tapnormal": [None, *range(-1, 8)],
    "capacidad": [None, 5],
    "configuracionladobaja": [None, 1, 1],
    "configuracionladomedia": [None, 1, 1],
    "corrientemaxcortocircuito": [None, 1, 1],
    "novedades": [None, 0, 1],
    "proyectoconstruccion": [None, "FOPE", "OTRO"],
    "nummedidor": [None, "M"],
    "edccod": [None, "A", "1", "W", "X"],
    "usuarioregistro": [None, "u"],
    "fecharegistro": [None, date(2015, 1, 1)],
    "usuariomodificacionregistro": [None, "v"],
    "fechamodificacionregistro": [None, date(2015, 3, 1)],
    "potenciakva": [p and Decimal(p) for p in POWERS],
}
TEXT_POWER = {"unidadcapacitor": [None, "12.5", "12,5", "0,005"]}


def random_rows(rng, name, count):
    if name == "alimentador":
        return [{"alimentadorid": str(i), "descripcion": f"F{i}"} for i in (1, 2)]
    if name == "catalogoestructura":
        texts = ["1S100", "2D200", "1S", None]
        return [{"codigoestructura": f"E{i}", "descripcioncorta": text} for i, text in enumerate(texts, 1)]

    def value(column, row):
        if column == "objectid":
            return row
        if column == "potencianominal":
            return rng.choice(TEXT_POWER.get(name) or DOMAINS["potenciakva"])
        return rng.choice(DOMAINS.get(column, KEYS))

    return [{column: value(column, i) for column in TABLES[name]} for i in range(count)]


def types_of(name):
    return {"potencianominal": "string"} if name in TEXT_POWER else {"corriente": "bigint"} if "dinamico" in name else {}


def duck_tables(rows):
    connection = duckdb.connect()
    for name, content in rows.items():
        special = types_of(name)
        kinds = {c: special.get(c) or KINDS.get(k) or AS_IS.get(c, "bigint") for c, k in TABLES[name].items()}
        connection.execute(f"create table {name} ({', '.join(f'{c} {kind}' for c, kind in kinds.items())})")
        if content:
            marks = ", ".join("?" for _ in kinds)
            held = [[None if row.get(c) == "" else row.get(c) for c in kinds] for row in content]  # an empty text is missing
            connection.executemany(f"insert into {name} values ({marks})", held)
    return connection


@pytest.mark.parametrize(("seed", "count", "broadcast"), [(1, 60, 200_000), (2, 60, 0), (3, 8, 200_000), (4, 0, 0)])
def test_random_network(spark, monkeypatch, seed, count, broadcast):
    monkeypatch.setattr(joins, "BROADCAST_ROWS", broadcast)
    monkeypatch.setattr(joins, "COPIES_PER_PIECE", 2)
    rng = random.Random(seed)
    rows = {name: random_rows(rng, name, count) for name in TABLES}
    for row in rows["puestoprotecciondinamico"]:
        row["corriente"] = rng.choice([None, 1, 1])
    net = network(spark, **{name: table(spark, name, content, **types_of(name)) for name, content in rows.items()})
    found = findings_with_rule(net, list(RULES.values()), RUN_DATE).collect()
    ours = Counter((row["rule_id"], *[row[c] for c in COLUMNS]) for row in found)

    duck = duck_tables(rows)
    views = {name: sql for name, sql in oracle._CTES.items() if name not in TABLES}
    prefix = "with " + ", ".join(f"{name} as ({sql})" for name, sql in views.items())
    theirs = Counter()
    for rule_id in RULES:
        result = duck.execute(f"{prefix} {oracle.findings_body([rule_id])}")
        order = [[c[0] for c in result.description].index(c) for c in COLUMNS]
        theirs.update((rule_id, *[row[i] for i in order]) for row in result.fetchall())
    for rule_id in RULES:
        mine = Counter({k: n for k, n in ours.items() if k[0] == rule_id})
        assert mine == Counter({k: n for k, n in theirs.items() if k[0] == rule_id}), rule_id

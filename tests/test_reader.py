"""What the reader makes of texts, fractions and times, and that rules then answer as for clean tables."""

import pytest
from helpers import RUN_DATE, found, network, table

from gridwarden import network_of, rule_findings
from gridwarden.functions import values

SPAN = {
    "objectid": 1, "codigoconductorfase": "E1", "codigoconductorneutro": "COO0000", "configuracionconductores": "11",
    "secuenciafase": "A", "faseconexion": 4,
}


@pytest.mark.parametrize(("kind", "value"), [("string", "7960.5"), ("double", 7960.5), ("bigint", 13800)])
def test_a_voltage_keeps_its_fraction(spark, kind, value):
    spans = table(spark, "tramodistribucionaereo", [{**SPAN, "voltaje": value}, {**SPAN, "objectid": 2, "voltaje": type(value)(7960)}], voltaje=kind)
    net = network(spark, tramodistribucionaereo=spans, tramodistribucionsubterraneo=[], catalogoestructura=[])
    assert found(net, "R11", "detail_1") == [(1, values.VOLTAGE_SINGLE)]


def test_a_repeated_catalog_code_repeats_the_finding(spark):
    rows = [{**SPAN, "voltaje": 1}, {**SPAN, "objectid": 2, "voltaje": 1, "codigoconductorfase": "E2"}]
    catalog = [{"codigoestructura": code, "descripcioncorta": "x"} for code in ("E1", "E1", "E1", "COO0000", "COO0000")]
    net = network(spark, tramodistribucionaereo=rows, tramodistribucionsubterraneo=[], catalogoestructura=catalog)
    assert [row[0] for row in found(net, "R11")] == [1] * 6 + [2] * 2


def test_a_tap_keeps_its_fraction(spark):
    units = [{"objectid": i, "puestotransfdistglobalid": "P", "tapnormal": tap} for i, tap in enumerate([5.5, 5.0, 0.9, 1.0])]
    net = network(
        spark,
        puestotransfdistribucion=[{"objectid": 1, "globalid": "P", "configuracionladobaja": 1, "configuracionladomedia": 1}],
        unidadtransfdistribucion=table(spark, "unidadtransfdistribucion", units, tapnormal="double"),
    )
    assert len(found(net, "R13")) == 2


def test_an_empty_text_is_missing(spark):
    spans = [{**SPAN, "codigoconductorfase": "", "voltaje": 7960}]
    connections = [{"objectid": i, "codigocliente": "", "codigounico": "", "puntocargaglobalid": "PC"} for i in (1, 2)]
    net = network(
        spark,
        tramodistribucionaereo=spans, tramodistribucionsubterraneo=[], conexionconsumidor=connections,
        puntocarga=[{"objectid": 5, "globalid": "PC"}], atributosconsumidor=[{"codigocliente": "", "codigounico": ""}],
    )
    assert found(net, "R10", "detail_1") == [(1, values.CONDUCTOR_MISSING)]
    assert found(net, "R18") == []
    assert found(net, "R21", "detail_1") == [(0, "Existen 2 registros")]
    assert [row[0] for row in found(net, "R22")] == [1, 2]


def test_novelty_keeps_its_fraction(spark):
    rows = [{"objectid": i, "novedades": novelty} for i, novelty in enumerate([0.4, 0.0])]
    net = network(spark, conexionconsumidor=table(spark, "conexionconsumidor", rows, novedades="double"))
    assert [row[0] for row in found(net, "R23")] == [1]


def test_times_in_texts_are_refused_unless_asked_for(spark):
    rows = [
        {"objectid": i, "codigocliente": "C", "puntocargaglobalid": "P", "fecharegistro": f"2015-01-01 0{i}:00:00"} for i in (1, 2)
    ]
    frames = {
        "conexionconsumidor": table(spark, "conexionconsumidor", rows, fecharegistro="string"),
        "puntocarga": table(spark, "puntocarga", [{"objectid": 1, "globalid": "P"}]),
        "atributosconsumidor": table(spark, "atributosconsumidor", [{"codigocliente": "C"}]),
        "alimentador": table(spark, "alimentador", []),
    }
    with pytest.raises(Exception, match="holds times of day"):
        rule_findings(network_of(frames), "R18", RUN_DATE).collect()
    assert found(network_of(frames, audit_date="timestamp"), "R18") == []


def test_fractional_codes_are_refused(spark):
    rows = table(spark, "puestoprotecciondinamico", [{"objectid": 1}], faseconexion="double")
    with pytest.raises(ValueError, match="can hold fractions"):
        rule_findings(network(spark, puestoprotecciondinamico=rows), "R12", RUN_DATE)

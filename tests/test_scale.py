"""What must hold for tables far larger than the tests': whole results without broadcasts, hot keys split."""

from collections import Counter
from contextlib import contextmanager

import pytest
from helpers import RUN_DATE, network, table
from pyspark.sql import functions as F

from gridwarden import RULES, all_findings, rule_findings
from gridwarden.functions import values
from gridwarden.operators import joins
from gridwarden.operators.joins import Lookup, spread_join
from gridwarden.plans.rules import fed_marks, transformer_units
from gridwarden.sources.star import star_network

SF_DIR = "/root/testdata/sf0.001"


@contextmanager
def settings(spark, **conf):
    before = {key: spark.conf.get(key, None) for key in conf}
    try:
        for key, value in conf.items():
            spark.conf.set(key, value)
        yield
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


NO_BROADCAST = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1"}
SPLIT_EARLY = {
    **NO_BROADCAST,
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "2KB",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "2KB",
}


def final_plan(frame):
    """The rows' number and the plan that ran, after AQE."""
    count = len(frame.collect())
    return count, frame._jdf.queryExecution().executedPlan().toString()


def test_same_findings_without_any_broadcast(spark, monkeypatch):
    normal = Counter(tuple(r) for r in all_findings(star_network(spark, SF_DIR), RUN_DATE).collect())
    monkeypatch.setattr(joins, "BROADCAST_ROWS", 0)
    with settings(spark, **NO_BROADCAST):
        frame = all_findings(star_network(spark, SF_DIR), RUN_DATE)
        plain = Counter(tuple(r) for r in frame.collect())
        assert "Broadcast" not in frame._jdf.queryExecution().executedPlan().toString()
    assert plain == normal


def test_rules_never_pair_all_rows(spark):
    net = star_network(spark, SF_DIR)
    for rule in RULES:
        plan = rule_findings(net, rule, RUN_DATE)._jdf.queryExecution().executedPlan().toString()
        assert "CartesianProduct" not in plan and "NestedLoop" not in plan, rule
        assert "Python" not in plan, rule


HOT, COLD, PARTS = 20_000, 4_000, 16


def hot_frame(spark, key, total=HOT + COLD, **columns):
    """Rows of which five in six share one key, spread over many map tasks."""
    value = F.when(F.col("id") % 6 != 0, F.lit("HOT")).otherwise(F.concat(F.lit("K"), (F.col("id") % 500).cast("string")))
    return spark.range(0, total, 1, PARTS).select(
        value.alias(key), F.col("id").alias("objectid"), *[c.alias(n) for n, c in columns.items()]
    )


def complete(spark, name, frame):
    """The frame with NULL for the columns it lacks."""
    empty = table(spark, name, [])
    return frame.select([F.col(f.name) if f.name in frame.columns else F.lit(None).cast(f.dataType).alias(f.name) for f in empty.schema])


def keyed(spark, name, key, **columns):
    """One row per key: HOT and 500 others."""
    frame = spark.range(501).select(
        F.when(F.col("id") == 500, "HOT").otherwise(F.concat(F.lit("K"), F.col("id").cast("string"))).alias(key),
        F.col("id").alias("objectid"),
        *[c.alias(n) for n, c in columns.items()],
    )
    return complete(spark, name, frame)


def hot_network(spark):
    phase = {"faseconexion": F.lit(7).cast("long")}
    lights = hot_frame(spark, "parentcircuitsourceguid", **phase)
    units = hot_frame(spark, "puestotransfdistglobalid", tapnormal=F.lit(0).cast("long"))
    fuses = hot_frame(spark, "puestosecfusibleglobalid")
    spans = hot_frame(spark, "parentcircuitsourceguid")
    connections = hot_frame(spark, "codigocliente", puntocargaglobalid=F.concat(F.lit("P"), F.col("id").cast("string")))
    points = spark.range(0, HOT + COLD, 1, PARTS).select(
        F.concat(F.lit("P"), F.col("id").cast("string")).alias("globalid"), F.col("id").alias("objectid")
    )
    own = F.when(F.col("id") == 500, "HOT").otherwise(F.concat(F.lit("K"), F.col("id").cast("string")))
    stations = keyed(spark, "puestotransfdistribucion", "globalid", circuitsourceguid=own, faseconexion=F.lit(4).cast("long"))
    return network(
        spark,
        luminaria=complete(spark, "luminaria", lights),
        unidadtransfdistribucion=complete(spark, "unidadtransfdistribucion", units),
        unidadfusible=complete(spark, "unidadfusible", fuses),
        tramobajatensionaereo=complete(spark, "tramobajatensionaereo", spans),
        tramobajatensionsubterraneo=[],
        conexionconsumidor=complete(spark, "conexionconsumidor", connections),
        puntocarga=complete(spark, "puntocarga", points),
        puestotransfdistribucion=stations,
        puestoseccionadorfusible=keyed(spark, "puestoseccionadorfusible", "globalid"),
        puestoprotecciondinamico=keyed(spark, "puestoprotecciondinamico", "circuitsourceguid", parentcircuitsourceguid=own),
        atributosconsumidor=keyed(spark, "atributosconsumidor", "codigocliente"),
    )


@pytest.mark.parametrize(
    ("rule", "expected"),
    [("R02", HOT + COLD), ("R04", 2 * (HOT + COLD)), ("R18", HOT + COLD)],
)
def test_hot_key_is_split(spark, monkeypatch, rule, expected):
    monkeypatch.setattr(joins, "BROADCAST_ROWS", 0)
    net = hot_network(spark)
    with settings(spark, **SPLIT_EARLY):
        count, plan = final_plan(rule_findings(net, rule, RUN_DATE))
    assert count == expected
    assert "skew=true" in plan


def test_hot_parent_key_is_split(spark):
    """Many stations under one id meet totals that are already aggregated by that id."""
    phase = F.lit(4).cast("long")
    net = network(
        spark,
        puestoseccionadorfusible=complete(spark, "puestoseccionadorfusible", hot_frame(spark, "globalid", faseconexion=phase)),
        unidadfusible=keyed(spark, "unidadfusible", "puestosecfusibleglobalid").where("objectid >= 250"),
    )
    with settings(spark, **SPLIT_EARLY):
        count, plan = final_plan(rule_findings(net, "R06", RUN_DATE))
    assert count == sum(1 for i in range(HOT + COLD) if i % 6 == 0 and i % 500 < 250)
    assert "skew=true" in plan


@pytest.mark.parametrize(("rule", "expected"), [("R07", HOT + COLD), ("R13", 2 * (HOT + COLD))])
def test_hot_parent_is_counted_and_repeated(spark, rule, expected):
    frame = rule_findings(hot_network(spark), rule, RUN_DATE)
    assert frame.count() == expected
    assert frame.where("feeder_id is null").groupBy("object_id").count().orderBy(F.desc("count")).first()["count"] >= HOT


def test_repeated_rows_are_whole_and_spread(spark, monkeypatch):
    monkeypatch.setattr(joins, "COPIES_PER_PIECE", 100)
    rows = spark.createDataFrame([(1, 50_000), (2, 1), (3, 0), (4, 100), (5, 101)], "id long, copies long")
    out = joins.repeat_rows(rows, "copies", "id").withColumn("part", F.spark_partition_id()).collect()
    assert Counter(r["id"] for r in out) == Counter({1: 50_000, 2: 1, 4: 100, 5: 101})
    hot = Counter(r["part"] for r in out if r["id"] == 1)
    assert len(hot) == 8 and max(hot.values()) < 2 * 50_000 / 8


@pytest.mark.parametrize("rule", ["R06", "R07", "R08", "R09", "R13", "R14", "R15", "R16", "R17", "R18", "R20", "R21", "R22", "R23"])
def test_counts_are_partial_before_the_shuffle(spark, rule):
    """A hot parent then costs the shuffle one row per map task, not one per child."""
    plan = rule_findings(star_network(spark, SF_DIR), rule, RUN_DATE)._jdf.queryExecution().executedPlan().toString()
    assert "partial_count" in plan or "partial_sum" in plan


def test_null_keys_are_spread(spark):
    many = spark.range(0, 8000, 1, 4).selectExpr("id as objectid", "if(id % 10 = 0, cast(id as string), null) as k")
    one = spark.range(8000).selectExpr("cast(id as string) as _k", "id as v")
    with settings(spark, **NO_BROADCAST, **{"spark.sql.adaptive.enabled": "false"}):
        joined = spread_join(many, one, "k", "_k", "objectid").withColumn("part", F.spark_partition_id())
        rows = joined.collect()
    assert len(rows) == 8000
    assert all((r["v"] is None) == (r["k"] is None) for r in rows)
    nulls = Counter(r["part"] for r in rows if r["k"] is None)
    assert len(nulls) == 8 and max(nulls.values()) < 2 * 7200 / 8


@pytest.mark.parametrize("rows", [0, 100])
def test_lookup_gives_one_value_per_row(spark, monkeypatch, rows):
    monkeypatch.setattr(joins, "BROADCAST_ROWS", rows)
    names = spark.createDataFrame([("a", "x"), ("a", "w"), ("b", "y"), (None, "z")], "k string, v string")
    many = spark.createDataFrame([(1, "a"), (2, "b"), (3, None), (4, "c"), (5, "a")], "id long, key string")
    lookup = Lookup(names, "k", "v")
    assert lookup.fits == (rows > 0)
    result = lookup.join_value(many, "key", "id", "name").collect()
    assert sorted((r["id"], r["name"]) for r in result if r["name"]) == [(1, "w"), (2, "y"), (5, "w")]
    assert len(result) == 5
    repeated = lookup.join_rows(many, "key", "id", "name").collect()
    assert len(repeated) == 7
    counted = lookup.join_count(many, "key", "id", "n").collect()
    assert sorted((r["id"], r["n"]) for r in counted) == [(1, 2), (2, 1), (3, 1), (4, 1), (5, 2)]


def test_few_breakers_need_no_shuffle_of_spans(spark):
    """Spans and lights meet the few own-parent breakers where they are read."""
    with settings(spark, **NO_BROADCAST):
        plan = fed_marks(star_network(spark, SF_DIR), {"R04"})._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" not in plan


def test_shared_plan_reads_no_table_more_often_than_it_must(spark):
    """Views, totals and features are read once for all rules that need them."""
    plan = all_findings(star_network(spark, SF_DIR), RUN_DATE)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan parquet") <= 31
    assert plan.count("Exchange hashpartitioning") <= 14


def test_catalog_size_does_not_change_what_r11_reads(spark, monkeypatch):
    """Only how the catalog travels depends on its size."""
    shapes = []
    for rows in (0, 200_000):
        monkeypatch.setattr(joins, "BROADCAST_ROWS", rows)
        plan = rule_findings(star_network(spark, SF_DIR), "R11", RUN_DATE)._jdf.queryExecution().optimizedPlan().toString()
        shapes.append((plan.count("Relation ["), plan.count("Aggregate [")))
    assert shapes[0] == shapes[1]


@pytest.mark.parametrize("rule", ["R02", "R04", "R07", "R11", "R13", "R18"])
def test_light_copies_stay_where_they_are(spark, rule):
    """Rows wanted a few times are copied in their task; only where a count is hot are they dealt out."""

    def dealt(net):
        return "REPARTITION_BY_NUM" in rule_findings(net, rule, RUN_DATE)._jdf.queryExecution().executedPlan().toString()

    assert not dealt(star_network(spark, SF_DIR))
    if rule in ("R07", "R13"):
        assert dealt(hot_network(spark))


def test_light_copies_are_whole(spark, monkeypatch):
    monkeypatch.setattr(joins, "COPIES_PER_PIECE", 100)
    rows = spark.createDataFrame([(1, 5_000), (2, 1), (3, 0), (4, 100), (5, 101)], "id long, copies long")
    out = joins.repeat_rows(rows, "copies", "id", hot=False)
    assert Counter(r["id"] for r in out.collect()) == Counter({1: 5_000, 2: 1, 4: 100, 5: 101})
    assert "Exchange" not in out._jdf.queryExecution().executedPlan().toString()


def test_most_rows_bounds_every_key(spark):
    rows = spark.createDataFrame([("a",)] * 5 + [("b",)] * 2 + [(None,)] * 7, "k string")
    assert joins.most_rows(rows, "k") == (7, 14)
    assert joins.most_rows(rows.where("k is not null"), "k") == (5, 7)
    assert joins.most_rows(rows.where("false"), "k") == (0, 0)
    assert joins.is_hot(10_001, 20_000) and not joins.is_hot(10_001, 64 * 10_001) and not joins.is_hot(7, 14)


def test_totals_meet_parents_without_a_second_shuffle(spark):
    """Units are shuffled once, by station, where phases are codes and no station's id is hot; stations and feeders too."""
    with settings(spark, **NO_BROADCAST):
        plan = rule_findings(star_network(spark, SF_DIR), "R13", RUN_DATE)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 3


def test_only_repeated_codes_of_a_large_catalog_are_looked_up(spark, monkeypatch):
    monkeypatch.setattr(joins, "BROADCAST_ROWS", 2)
    codes = spark.createDataFrame([("a", "x"), ("a", "w"), *[(f"c{i}", "y") for i in range(9)]], "k string, v string")
    many = spark.createDataFrame([(1, "a"), (2, "c1"), (3, None), (4, "none"), (5, "a")], "id long, key string")
    lookup = Lookup(codes, "k", "v")
    assert not lookup.fits and lookup.most == 2
    with settings(spark, **NO_BROADCAST):
        counted = lookup.join_count(many, "key", "id", "n")
        plan = counted._jdf.queryExecution().executedPlan().toString()
        assert sorted((r["id"], r["n"]) for r in counted.collect()) == [(1, 2), (2, 1), (3, 1), (4, 1), (5, 2)]
        absent = lookup.join_count(many, "key", "id", "n", absent=0).collect()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
    assert sorted((r["id"], r["n"]) for r in absent) == [(1, 2), (2, 1), (3, 0), (4, 0), (5, 2)]


@pytest.mark.parametrize("strange", [None, 9])
def test_repeated_phases_are_counted_for_any_code(spark, strange):
    """Units are counted by code in columns, or, with codes that no phase has, by code in rows: the same findings."""
    units = [{"objectid": i, "puestotransfdistglobalid": "S", "faseconexion": code} for i, code in enumerate([1, 1, 2, None, None, None, 0, 0])]
    units += [{"objectid": 20 + i, "puestotransfdistglobalid": "T", "faseconexion": strange} for i in range(2)]
    stations = [
        {"objectid": i, "globalid": name, "faseconexion": 7, "subtipo": values.BANK_SUBTYPES[0], "potenciakva": None}
        for i, name in enumerate("STU")
    ]
    net = network(spark, puestotransfdistribucion=stations, unidadtransfdistribucion=units)
    assert net.holds_only("unidadtransfdistribucion", "faseconexion", range(8)) == (strange is None)
    seen = transformer_units(net).select("objectid", "repeated", "_rows", "_units", "_phases").collect()
    found = {r["objectid"]: (sorted(((x["value"], x["repeats"]) for x in r["repeated"]), key=str) if r["repeated"] is not None else None, *r[2:]) for r in seen}
    assert found == {0: ([(0, 2), (1, 2), (None, 3)], 8, 8, 4), 1: ([(strange, 2)], 2, 2, 2 * (strange or 0)), 2: (None, None, None, None)}

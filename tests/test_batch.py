"""The batch run, the report and the census."""

from collections import Counter
from datetime import date, datetime
from itertools import product
from time import sleep

import pytest
from pyspark.sql import DataFrameWriter
from pyspark.sql import functions as F
from helpers import RUN_DATE, network, table

import __spark_entry__ as entry
from gridwarden import (
    BATCH,
    RULES,
    all_findings,
    history,
    read_findings,
    report,
    rule_findings,
    run_date_of,
    run_failures,
    run_validation,
    superseded_runs,
)
from gridwarden.functions import values
from gridwarden.functions.phases import letters_outside, phase_count, phases_outside
from gridwarden.operators.census import lasting_census, non_null_census, select_layers
from gridwarden.operators.findings import Check
from gridwarden.plans import batch, runs
from gridwarden.plans.rules import Rule, findings_with_rule
from gridwarden.sources.catalog import catalog_frames, footer_session
from gridwarden.sources.network import Network, read_network, read_network_tables
from gridwarden.sources.star import ADAPTERS, star_catalog, star_database, star_database_layers, star_network

SF_DIR = "/root/testdata/sf0.001"
NOON = datetime(2015, 4, 2, 12, 0, 0)


def breakers(spark, **frames):
    return network(spark, puestoprotecciondinamico=[{"objectid": 1, "alimentadorid": "1"}], **frames)


def run(spark, net, path, rules, run_date=RUN_DATE):
    return run_validation(spark, net, str(path), run_date, rules, clock=lambda: NOON)


def rows(findings):
    return Counter((r["category"], r["object_id"], r["detail_1"], r["detail_2"]) for r in findings.collect())


def test_run_has_start_and_end(spark, tmp_path):
    result = run(spark, breakers(spark), tmp_path / "run", [RULES["R12"]]).collect()
    info = [r for r in result if r["category"] == "INFO"]
    assert [(r["element"], r["object_id"], r["detail_1"], r["run_date"]) for r in info] == [
        (" ", 0, "02/04/2015 12:00:00", RUN_DATE)
    ] * 2
    assert {r["rule"] for r in info} == {values.RUN_STARTED, values.RUN_FINISHED}
    assert len(result) == 3


def test_rerun_replaces(spark, tmp_path):
    net = breakers(spark, puestoseccionadorfusible=[{"objectid": 2, "faseconexion": 4, "globalid": "A"}], unidadfusible=[])
    path = tmp_path / "run"
    run(spark, net, path, [RULES["R06"]], date(2015, 1, 1))
    run(spark, net, path, [RULES["R12"]])
    again = read_findings(spark, str(path))
    assert {r["object_id"] for r in again.collect()} == {0, 1}
    assert run_date_of(again) == RUN_DATE


def test_missing_table_fails_its_rule_only(spark, tmp_path):
    result = run(spark, breakers(spark), tmp_path / "run", [RULES["R12"], RULES["R07"]]).collect()
    failed = [r for r in result if r["category"] == "ERROR"]
    assert len(failed) == 1
    assert failed[0]["rule"] == "ERROR: table puestoseccionadorfusible is not in the network"
    assert failed[0]["detail_1"] == "Procedimiento: fuse_capacity_missing"
    assert failed[0]["detail_2"] == values.RULE_TITLES["R07"][1]
    assert [r["object_id"] for r in result if r["category"] == "ADMS"] == [1]


def test_rule_that_fails_while_running(spark, tmp_path):
    broken = Rule("X01", "broken_rule", plan=entry.failing_plan, heading=("ADMS", "Broken rule"))
    net = breakers(spark, conexionconsumidor=[{"objectid": 7}])
    result = run(spark, net, tmp_path / "run", [broken, RULES["R12"], RULES["R21"]])
    assert rows(result) == Counter(
        {
            ("INFO", 0, "02/04/2015 12:00:00", None): 2,
            ("ERROR", 0, "Procedimiento: broken_rule", "Broken rule"): 1,
            ("ADMS", 1, f"{values.CURRENT_MISSING};{values.SHORT_CIRCUIT_MISSING}", f"{values.PHASE_MISSING};{values.VOLTAGE_MISSING}"): 1,
            ("ADMS", 0, "Existen 1 registros", None): 1,
        }
    )
    assert [r["rule"] for r in result.collect() if r["category"] == "ERROR"][0].startswith(
        "ERROR: [USER_RAISED_EXCEPTION] broken on purpose"
    )


def test_every_rule_fails(spark, tmp_path):
    result = run(spark, network(spark), tmp_path / "run", [RULES["R12"]])
    assert Counter(r["category"] for r in result.collect()) == Counter({"INFO": 2, "ERROR": 1})


def test_report_messages(spark, tmp_path):
    assert report(spark, str(tmp_path / "nowhere")).message.startswith(values.READ_FAILURE)
    findings, path = findings_with_rule(breakers(spark), [RULES["R12"]], RUN_DATE), str(tmp_path / "some")
    for rows_, message in ((findings, None), (findings.where("false"), values.NO_FINDINGS)):
        name = runs.new_run(RUN_DATE)
        runs.commit(spark, path, name, RUN_DATE, [runs.write_part(rows_, path, name, "all")])
        assert report(spark, path).message == message
    assert report(spark, path, date(2016, 1, 1)).message.startswith(values.READ_FAILURE)


class Killed(BaseException):
    """Stands for the end of the driver: no handler of the run sees it."""


def test_a_run_killed_at_any_write_leaves_the_old_one(spark, tmp_path, monkeypatch):
    net = breakers(spark, puestoseccionadorfusible=[{"objectid": 2, "faseconexion": 4, "globalid": "A"}], unidadfusible=[])
    path, rules = tmp_path / "run", [RULES["R06"], RULES["R12"]]
    run(spark, net, path, [RULES["R12"]])
    before, parquet = rows(read_findings(spark, str(path))), DataFrameWriter.parquet
    monkeypatch.setattr(batch, "JOBS_AT_ONCE", 1)
    for last in range(6):
        left = [last]

        def write(writer, target, *args, **options):
            if not left[0]:
                raise Killed
            left[0] -= 1
            parquet(writer, target, *args, **options)

        monkeypatch.setattr(DataFrameWriter, "parquet", write)
        if last < 5:  # start, two groups, finish, manifest
            with pytest.raises(Killed):
                run(spark, net, path, rules)
            assert rows(report(spark, str(path)).findings) == before
        else:
            run(spark, net, path, rules)
    assert sum(rows(report(spark, str(path)).findings).values()) == 4
    assert superseded_runs(spark, str(path)).count() == 1


def test_only_the_failing_group_is_redone(spark, tmp_path, monkeypatch):
    """A broken check on the breakers shares a job with R12; no other rule runs twice."""
    net, path, written = star_network(spark, SF_DIR), str(tmp_path / "run"), []
    bad = Check("X02", "x", "cast(raise_error('broken on purpose') as boolean)")
    broken = Rule("X02", "broken_check", checks=lambda _: [("breaker", bad)], heading=("ADMS", "Broken check"))
    write_part = runs.write_part
    monkeypatch.setattr(runs, "write_part", lambda *args: written.append(args[3]) or write_part(*args))
    found = run(spark, net, path, [*BATCH, broken])
    groups = batch.rule_groups(net, [*BATCH, broken])
    assert [{r.rule_id for r in g} for g in groups if "R12" in {r.rule_id for r in g}] == [{"R12", "X02"}]
    assert runs.newest(spark, path)["alone"] == ["R12", "X02"]
    assert len(written) == len(groups) + len(["start", "finish", "R12", "X02", "failure of X02"])
    assert len([r for r in found.collect() if r["category"] == "ERROR"]) == 1
    alone = all_findings(net, RUN_DATE).count()
    assert found.count() == alone + 3


def test_groups_share_what_they_read(spark):
    groups = [{r.rule_id for r in group} for group in batch.rule_groups(star_network(spark, SF_DIR), BATCH)]
    assert {"R08", "R09"} in groups and {"R02", "R04"} in groups and {"R12"} in groups
    assert any({"R01", "R03", "R10", "R11", "R14"} <= group for group in groups)
    assert sorted(r for group in groups for r in group) == sorted(r.rule_id for r in BATCH)


def test_a_failure_of_the_storage_is_recorded_elsewhere(spark, tmp_path):
    blocked, failures = tmp_path / "file", str(tmp_path / "log")
    blocked.write_text("no folder")
    for _ in range(2):
        with pytest.raises(Exception):  # noqa: B017
            run_validation(spark, breakers(spark), str(blocked), RUN_DATE, [RULES["R12"]], log_path=failures)
    recorded = run_failures(spark, failures).collect()
    assert [(r["category"], r["object_id"], r["detail_1"], r["run_date"]) for r in recorded] == [
        ("ERROR", 0, "Procedimiento: run_validation", RUN_DATE)
    ] * 2
    assert all(r["rule"].startswith("ERROR: ") for r in recorded)


def test_values_that_cannot_be_read_leave_a_row(spark, tmp_path):
    """Texts where codes and dates are expected; the run's only job over the table counts them."""
    frame = table(
        spark,
        "puestoprotecciondinamico",
        [
            {"objectid": "1", "faseconexion": "2.5", "fecharegistro": "2015-01-01"},
            {"objectid": "2", "faseconexion": "1A", "fecharegistro": "soon"},
            {"objectid": "3", "faseconexion": "", "fecharegistro": None},
            {"objectid": "4", "faseconexion": " 7 ", "voltaje": "7960"},
        ],
        objectid="string", faseconexion="string", fecharegistro="string", voltaje="string",
    )
    found = run(spark, network(spark, puestoprotecciondinamico=frame), tmp_path / "run", [RULES["R12"]])
    errors = sorted((r["rule"], r["detail_1"], r["detail_2"]) for r in found.collect() if r["category"] == "ERROR")
    assert errors == [
        ("ERROR: valores no legibles: 1", "Tabla: puestoprotecciondinamico", "Columna: fecharegistro"),
        ("ERROR: valores no legibles: 2", "Tabla: puestoprotecciondinamico", "Columna: faseconexion"),
    ]
    again = run(spark, network(spark, puestoprotecciondinamico=frame.where("objectid = 4")), tmp_path / "run", [RULES["R12"]])
    assert not again.where("category = 'ERROR'").count()


def test_counting_unreadable_values_scans_nothing_more(spark):
    """The counts stand in the same plan, over the same number of scans."""
    base = star_network(spark, SF_DIR)
    texts = Network(lambda n: base.load(n).withColumns({c: F.col(c).cast("string") for c in base.load(n).columns if c in ("faseconexion", "subtipo")}))
    plans = [all_findings(net, RUN_DATE, [RULES["R01"], RULES["R12"]])._jdf.queryExecution().executedPlan().toString() for net in (texts, texts.traced())]
    assert plans[0].count("Scan parquet") == plans[1].count("Scan parquet") > 0
    assert "CollectMetrics" in plans[1] and "CollectMetrics" not in plans[0]


def test_history_keeps_the_last_run_of_each_date(spark, tmp_path):
    net, path, other = breakers(spark, conexionconsumidor=[{"objectid": 7}]), tmp_path / "run", date(2016, 1, 1)
    run(spark, net, path, [RULES["R12"], RULES["R21"]])
    run(spark, net, path, [RULES["R12"]], other)
    run(spark, net, path, [RULES["R21"]])
    assert run_date_of(read_findings(spark, str(path))) == RUN_DATE
    for day, objects in ((RUN_DATE, {0}), (other, {0, 1})):
        kept = read_findings(spark, str(path), day)
        assert run_date_of(kept) == day and {r["object_id"] for r in kept.collect()} == objects
    assert sorted(history(spark, str(path)).groupBy("run_date").count().collect()) == [(RUN_DATE, 3), (other, 3)]


def test_run_date_must_be_one(spark):
    findings = rule_findings(breakers(spark), "R12", RUN_DATE)
    with pytest.raises(ValueError, match="none"):
        run_date_of(findings.where("false"))
    with pytest.raises(ValueError, match="several"):
        run_date_of(findings.union(rule_findings(breakers(spark), "R12", date(2016, 1, 1))))


def test_shared_plan_equals_rules_one_by_one(spark):
    net = star_network(spark, SF_DIR)
    shared = Counter(tuple(r) for r in all_findings(net, RUN_DATE).collect())
    alone = Counter()
    for rule in BATCH:
        alone.update(tuple(r) for r in rule_findings(net, rule, RUN_DATE).collect())
    assert shared == alone


def test_read_network_from_files_and_tables(spark, tmp_path):
    spark.sql("create database if not exists grid")
    for name in ("puestocorrectorfactorpotencia", "unidadcapacitor", "alimentador"):
        adapted = star_network(spark, SF_DIR)[name]
        adapted.write.mode("overwrite").orc(f"{tmp_path}/{name}")
        adapted.write.mode("overwrite").saveAsTable(f"grid.{name}")
    expected = rows(rule_findings(star_network(spark, SF_DIR), "R09", RUN_DATE))
    for net in (read_network(spark, str(tmp_path), "orc"), read_network_tables(spark, "grid")):
        assert rows(rule_findings(net, "R09", RUN_DATE)) == expected


def test_layers_of_the_catalog(spark):
    kept = select_layers(*star_catalog(spark))
    assert sorted(r["table_name"] for r in kept.collect()) == ["LUMINARIA", "PUESTOSECCIONADORFUSIBLE", "PUESTOTRANSFDISTRIBUCION"]


def test_census_of_the_spark_catalog(spark):
    spark.sql("create database if not exists sigelec")
    for name, column in [("postes", "ordentrabajo"), ("a1", "ordentrabajo"), ("otros", "x"), ("oculta", "ordentrabajo")]:
        spark.createDataFrame([("o1",), (None,)], f"{column} string").write.mode("overwrite").saveAsTable(f"sigelec.{name}")
    layers = spark.createDataFrame([("POSTES",), ("A1",), ("OTROS",)], "table_name string")
    kept = select_layers(*catalog_frames(spark, ["sigelec"]), layers)
    census = non_null_census(spark, kept, lambda name: spark.table(f"sigelec.{name}"))
    assert [tuple(r) for r in census.collect()] == [("POSTES", 1)]


def test_census(spark):
    layers = spark.createDataFrame([("FULL",), ("EMPTY",)], "table_name string")
    frames = {
        "FULL": spark.createDataFrame([("a",), (None,), ("b",)], "ordentrabajo string"),
        "EMPTY": spark.createDataFrame([], "ordentrabajo string"),
    }
    census = non_null_census(spark, layers, frames.__getitem__, view=values.CENSUS_VIEW)
    assert sorted(tuple(r) for r in census.collect()) == [("EMPTY", 0), ("FULL", 2)]
    assert spark.table(values.CENSUS_VIEW).count() == 2
    nothing = non_null_census(spark, layers.where("false"), frames.__getitem__)
    assert nothing.collect() == [] and nothing.columns == ["feat", "ots"]


def test_adapters_cover_the_network():
    from gridwarden.sources.network import TABLES

    assert set(ADAPTERS) == set(TABLES)


def test_phase_expressions_equal_letter_sets(spark):
    """The mask forms against sets of letters, for every pair of codes and NULL."""
    letters = {None: None, 0: None, 8: None, **{code: set(text) for code, text in values.PHASE_LETTERS.items()}}
    pairs = spark.createDataFrame(list(product(letters, letters)), "a bigint, b bigint")
    texts = "get(array(null, 'C', 'B', 'BC', 'A', 'AC', 'AB', 'ABC'), cast(a as int))"
    out = pairs.selectExpr(
        "a",
        "b",
        f"{phase_count('a')} as n",
        f"coalesce({phases_outside('a', 'b')}, false) as outside",
        f"coalesce({letters_outside(texts, 'b')}, false) as text_outside",
    )
    for row in out.collect():
        mine, allowed = letters[row["a"]], letters[row["b"]]
        assert row["n"] == (len(mine) if mine else None)
        expected = bool(mine and allowed and mine - allowed)
        assert row["outside"] == expected
        assert row["text_outside"] == expected


def test_expected_feeder_code_is_the_mirrored_phase():
    for code, info in values.FEEDER_INFO.items():
        assert info == int(f"{code:03b}"[::-1], 2)


def test_selection_reads_the_catalog(spark):
    """A table of changes, a name in two databases, another owner's table and a table that is no layer are left out."""
    database = star_database(spark, SF_DIR, entry.shared_folder(spark))
    tables, columns, layers = star_database_layers(spark, database)
    ordered = {r["table_name"] for r in columns.where("column_name = 'ORDENTRABAJO'").collect()}
    assert {"D1_LUMINARIA", "LUMINARIA_ANTIGUA", "PUESTO_RETIRADO"} < ordered
    expected = ["LUMINARIA", "PUESTOSECCIONADORFUSIBLE", "PUESTOTRANSFDISTRIBUCION"]
    kept = select_layers(tables, columns, layers, owner=database.upper())
    assert sorted(r["table_name"] for r in kept.collect()) == expected
    twice = select_layers(tables, columns, layers.union(layers.where("table_name = 'LUMINARIA'")), owner=database.upper())
    assert sorted(r["table_name"] for r in twice.collect()) == expected[1:]
    again = star_database(spark, SF_DIR, entry.shared_folder(spark))
    assert again == database and spark.table(f"{database}.st_geometry_columns").count() == layers.count()


def test_lasting_census_outlives_its_session_and_follows_the_tables(spark):
    spark.sql("create database if not exists redes_2")
    spark.createDataFrame([("o1",), (None,)], "ordentrabajo string").write.mode("overwrite").saveAsTable("redes_2.postes")
    layers = spark.createDataFrame([("POSTES",), ("POSTES",)], "table_name string")
    lasting_census(spark, layers, "redes_2", "v_ordenes")
    other = spark.newSession()
    assert [tuple(r) for r in other.table("redes_2.v_ordenes").collect()] == [("POSTES", 1)]
    spark.createDataFrame([("o3",)], "ordentrabajo string").write.mode("append").saveAsTable("redes_2.postes")
    other.sql("refresh table redes_2.postes")
    for reader in (other, spark.newSession()):
        assert [tuple(r) for r in reader.table("redes_2.v_ordenes").collect()] == [("POSTES", 2)]
    nothing = lasting_census(spark, layers.where("false"), "redes_2", "v_ordenes")
    assert nothing.collect() == [] and nothing.columns == ["feat", "ots"]


def test_census_counts_from_footers(spark, tmp_path):
    frame = spark.range(0, 1000, 1, 4).selectExpr("if(id % 3 = 0, null, cast(id as string)) as ordentrabajo", "id")
    frame.write.parquet(f"{tmp_path}/POSTES")
    frame.limit(0).write.parquet(f"{tmp_path}/VACIA")
    fast = footer_session(spark)
    layers = spark.createDataFrame([("POSTES",), ("VACIA",)], "table_name string")
    pushed = non_null_census(fast, layers, lambda name: fast.read.parquet(f"{tmp_path}/{name}"))
    scanned = non_null_census(spark, layers, lambda name: spark.read.parquet(f"{tmp_path}/{name}"))
    plan = pushed._jdf.queryExecution().executedPlan().toString()
    assert plan.count("PushedAggregation: [COUNT(ordentrabajo)]") == 2
    assert sorted(tuple(r) for r in scanned.collect()) == sorted(tuple(r) for r in pushed.collect()) == [("POSTES", 666), ("VACIA", 0)]
    filled = fast.read.parquet(f"{tmp_path}/POSTES").where("id < 10").selectExpr("count(ordentrabajo) as n")
    assert filled.first()["n"] == 6  # with a filter the rows are scanned


def shuffle_files(spark):
    files = spark.sparkContext._jsc.sc().env().blockManager().diskBlockManager().getAllFiles()
    return {files.apply(i).getName() for i in range(files.size()) if files.apply(i).getName().startswith("shuffle_")}


def test_a_run_leaves_no_shuffle_files_and_shuffles_no_finding_to_write_it(spark, tmp_path, monkeypatch):
    """Without any garbage collection; the session's own setting is as it was."""
    net, path = star_network(spark, SF_DIR), tmp_path / "run"
    before = spark.conf.get(runs.ShufflesFreed.KEY)
    found = findings_with_rule(net, [RULES["R07"]], RUN_DATE)
    net.is_hot("unidadfusible", "puestosecfusibleglobalid")  # measured before, by a job of its own
    kept = shuffle_files(spark)
    runs.write_part(found, str(path), "some", "all")
    for _ in range(50):  # files go shortly after the job
        if not shuffle_files(spark) - kept:
            break
        sleep(0.2)
    assert not shuffle_files(spark) - kept
    assert spark.conf.get(runs.ShufflesFreed.KEY) == before
    written, parquet = [], DataFrameWriter.parquet
    monkeypatch.setattr(DataFrameWriter, "parquet", lambda writer, *args: written.append(writer._df) or parquet(writer, *args))
    runs.write_part(found, str(path), "other", "all")
    assert "REBALANCE" not in written[0]._jdf.queryExecution().executedPlan().toString()
    assert spark.read.parquet(f"{path}/runs/other/part=all").count() == found.count() > 0


def test_asking_for_the_run_date_leaves_no_shuffle_files(spark):
    found = rule_findings(star_network(spark, SF_DIR), "R07", RUN_DATE)
    kept = shuffle_files(spark)
    assert run_date_of(found) == RUN_DATE
    for _ in range(50):  # files go shortly after the job
        if not shuffle_files(spark) - kept:
            break
        sleep(0.2)
    assert not shuffle_files(spark) - kept

"""Jobs end to end on synthetic exports."""

import json

from vigil.plans.jobs import activity_report, land_activity, land_initiatives, update_manifest
from tests.test_json_flatten import activity_doc


def test_land_and_report_activity(spark, tmp_path):
    src = tmp_path / "atividadedeputadoxv.json"
    src.write_text(json.dumps(activity_doc(), ensure_ascii=False))
    out, bad = str(tmp_path / "act"), str(tmp_path / "bad")
    land_activity(spark, str(src), out, bad, partitions=4)
    act = spark.read.parquet(out)
    assert act.count() == 11 and spark.read.parquet(bad).count() == 3
    assert act.where("source_file like '%atividadedeputadoxv.json'").count() == 11
    rep = activity_report(act)
    assert {r.column_name for r in rep["null_profile"].collect()} >= {"mp_id", "act_desc"}
    w = {r.mp_name: r.act_weight for r in rep["coauthor_weight"].collect()}
    assert w == {"Ana Alfa": 9.0, "Bruno Beta": 2.0}  # no shared activities: weight 1 each


def test_land_initiatives(spark, tmp_path):
    doc = {"ArrayOfPt_gov_ar_objectos_iniciativas_DetalhePesquisaIniciativasOut": {
        "pt_gov_ar_objectos_iniciativas_DetalhePesquisaIniciativasOut": {
            "iniNr": "1", "iniTipo": "P", "iniLeg": "XV", "iniSel": "1", "iniTitulo": "T",
            "iniLinkTexto": "u", "iniEventos": {"pt_gov_ar_objectos_iniciativas_EventosOut":
                                                 {"fase": "Entrada", "dataFase": "2023-01-01"}}}}}
    src = tmp_path / "ini.json"
    src.write_text(json.dumps(doc))
    land_initiatives(spark, str(src), str(tmp_path / "ini"))
    r = spark.read.parquet(str(tmp_path / "ini")).first()
    assert (r.id, r.entry_date, r.number_authors) == ("1/P/XV/1", "2023-01-01", 0)


def test_update_manifest(spark, tmp_path):
    runs = tmp_path / "runs"
    runs.mkdir()
    (runs / "2023_02_01_00_00_00.csv").write_text(
        "crawl_time,file_path,parent_url,file_url\n"
        "2023-02-01 00:00:01,data/a.json,p,u1\n2023-02-01 00:00:02,data/b.json,p,u2\n")
    landed = tmp_path / "root" / "data"
    landed.mkdir(parents=True)
    (landed / "a.json").write_text("{}")
    pend = update_manifest(spark, str(runs), str(tmp_path / "root"), str(tmp_path / "out"),
                           "2023_02_02_00_00_00")
    assert [r.file_path for r in pend.collect()] == ["data/b.json"]
    from vigil.sources.manifest import read_manifests
    m = {r.file_path: r for r in read_manifests(spark, str(tmp_path / "out")).collect()}
    assert m["data/a.json"].download_status == 200 and m["data/b.json"].download_status is None


def test_initiative_report(spark):
    from vigil.plans.jobs import initiative_report
    df = spark.createDataFrame([("1", "A", 1), ("2", "A", 3), ("3", "B", 2), ("4", None, 1)],
                               "id string, party string, number_authors int")
    rep = initiative_report(df)
    assert {(r.party, r.number_authors): r["count"] for r in rep["authors_per_party"].collect()} == {
        ("A", 1): 1, ("A", 3): 1, ("B", 2): 1}
    h = {(r.party, r.bin): r["count"] for r in rep["author_histogram"].collect()}
    assert h[("A", 1)] == 1 and h[("A", 10)] == 1 and h[("B", 6)] == 1 and sum(h.values()) == 3


def test_partitioned_activity_table_prunes(spark, tmp_path):
    src = tmp_path / "a.json"
    src.write_text(json.dumps(activity_doc(), ensure_ascii=False))
    out = str(tmp_path / "act_by_type")
    land_activity(spark, str(src), out, str(tmp_path / "bad2"), partitions=2, partition_by=("act_type",))
    rin = spark.read.parquet(out).where("act_type = 'rpe'")
    assert rin.count() == 2
    plan = rin._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(act_type" in plan and "rpe" in plan

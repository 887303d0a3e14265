"""The four shapes of the other exports, on invented documents."""

import hashlib
import json

import pytest
from pyspark.sql import functions as F

from vigil.functions import jsonx as J
from vigil.sources.files import read_landed
from vigil.sources.nested_json import read_documents, records

MEETINGS = {"ArrayOfReuniao": {"@xmlns:xsd": "x", "Reuniao": [
    {"id": "1", "participantes": {"Participante": {"nome": "Ana", "gp": "X"}}},
    {"id": "2", "participantes": {"Participante": [{"nome": "Bela", "gp": "X"}, {"nome": "Caio", "gp": "Y"}]}},
    {"id": "3", "participantes": None}]}}
GROUPS = {"ArrayOfGrupodeAmizade": {"GrupodeAmizade": [
    {"id": "10", "composicao": {"Membro": [{"nome": "m%d" % i} for i in range(4)]}},
    {"id": "11", "composicao": {"Membro": {"nome": "only"}}}, {"id": "12"}]}}
COOPERATION = {"ArrayOfCooperacao": {"Cooperacao": [
    {"atividades": {"Atividade": [{"participantes": {"Participante": [{"n": "a"}, {"n": "b"}]}}, {"participantes": {"Participante": {"n": "c"}}}]}},
    {"programas": {"Cooperacao": {"atividades": {"Atividade": [{"x": 1}, {"x": 2}, {"x": 3}]}}}}]}}
INTERVENTION = {"ArrayOfOut": {"Out": {"id": "77", "texto": "só uma"}}}


@pytest.fixture(scope="module")
def folder(tmp_path_factory):
    d = tmp_path_factory.mktemp("exports")
    for name, doc in (("a", MEETINGS), ("b", GROUPS), ("c", COOPERATION), ("d", INTERVENTION)):
        (d / f"{name}.json").write_text(json.dumps(doc, ensure_ascii=False))
    return d


def _recs(spark, folder, root):
    return records(read_documents(spark, str(folder)), root)


def test_landed_md5(spark, folder):
    got = {r.download_md5 for r in read_landed(spark, str(folder), glob="*.json").collect()}
    assert got == {hashlib.md5(p.read_bytes()).hexdigest() for p in folder.iterdir()}


def test_meetings_participants_object_or_array(spark, folder):
    recs = _recs(spark, folder, "ArrayOfReuniao.Reuniao")
    assert recs.count() == 3
    parts = recs.select(F.explode(J.json_array(J.path("record", "$.participantes.Participante"))).alias("p"))
    assert {r[0]: r[1] for r in parts.groupBy(J.path("p", "$.gp")).count().collect()} == {"X": 2, "Y": 1}


def test_group_members(spark, folder):
    recs = _recs(spark, folder, "ArrayOfGrupodeAmizade.GrupodeAmizade")
    members = recs.select(J.path("record", "$.id").alias("gid"),
                          F.explode(J.json_array(J.path("record", "$.composicao.Membro"))).alias("m"))
    assert {r["gid"]: r["count"] for r in members.groupBy("gid").count().collect()} == {"10": 4, "11": 1}


def test_cooperation_nested_activities(spark, folder):
    recs = _recs(spark, folder, "ArrayOfCooperacao.Cooperacao")
    direct = recs.select(F.explode(J.json_array(J.path("record", "$.atividades.Atividade"))).alias("a"))
    nested = (recs.select(F.explode(J.json_array(J.path("record", "$.programas.Cooperacao"))).alias("p"))
              .select(F.explode(J.json_array(J.path("p", "$.atividades.Atividade"))).alias("a")))
    assert (recs.count(), direct.count(), nested.count()) == (2, 2, 3)
    assert direct.select(F.explode(J.json_array(J.path("a", "$.participantes.Participante")))).count() == 3


def test_bare_root_object(spark, folder):
    assert [J_["record"] for J_ in _recs(spark, folder, "ArrayOfOut.Out").collect()] == ['{"id":"77","texto":"só uma"}']

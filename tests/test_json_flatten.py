"""Polymorphic JSON: object-or-array normalisation, member-activity and
initiative flattening on small synthetic documents (invented names)."""

import json

from pyspark.sql import functions as F

from vigil.functions import jsonx as J
from vigil.operators.activity import ACTIVITY_ROOT, flatten_activity
from vigil.operators.initiative import INITIATIVE_ROOT, flatten_initiatives
from vigil.sources.nested_json import read_documents, records


def _write(tmp_path, name, obj):
    p = tmp_path / name
    p.write_text(json.dumps(obj, ensure_ascii=False))  # one line, no newline
    return str(p)


def _meeting(i, parts):
    return {"id": str(i), "nome": f"Meeting {i}",
            "participantes": {"Participante": parts[0] if len(parts) == 1 else parts}}


def test_object_or_array_participants(spark, tmp_path):
    meetings = [_meeting(1, [{"nome": "A", "gp": "X"}]),
                _meeting(2, [{"nome": "B", "gp": "X"}, {"nome": "C", "gp": "Y"}]),
                _meeting(3, [{"nome": "D", "gp": "Y"}]),
                {"id": "4", "nome": "Meeting 4", "participantes": None}]
    doc = {"?xml": {"@version": "1.0"}, "ArrayOfReuniao": {"@xmlns:xsd": "x", "Reuniao": meetings}}
    path = _write(tmp_path, "meetings.json", doc)
    recs = records(read_documents(spark, path), "ArrayOfReuniao.Reuniao")
    assert recs.count() == 4
    parts = recs.select(F.explode_outer(J.json_array(J.path("record", "$.participantes.Participante")))
                        .alias("p")).where(F.col("p").isNotNull())
    by_gp = {r[0]: r[1] for r in parts.groupBy(J.path("p", "$.gp")).count().collect()}
    assert by_gp == {"X": 2, "Y": 2}


def test_bare_object_root_gives_one_row(spark, tmp_path):
    doc = {"ArrayOfThing": {"Thing": {"id": "1", "x": None}}}
    recs = records(read_documents(spark, _write(tmp_path, "one.json", doc)), "ArrayOfThing.Thing")
    assert recs.count() == 1


def test_unwrap_levels(spark):
    df = spark.createDataFrame([('{"w":{"a":1,"b":2}}',), ('{"o":{"w":{"a":1,"b":2}}}',),
                                ('{"w":[{"a":1},{"a":2}]}',), ('{"a":1,"b":2}',)], "j string")
    got = [r[0] for r in df.select(J.unwrap_single_key("j")).collect()]
    assert [json.loads(g) for g in got] == [{"a": 1, "b": 2}, {"a": 1, "b": 2},
                                            [{"a": 1}, {"a": 2}], {"a": 1, "b": 2}]


def test_unwrap_has_no_depth_limit(spark):
    deep = {"a": 1, "b": {"c": 2}}
    for i in range(9):
        deep = {"w{\\\"%d" % i: deep}
    df = spark.createDataFrame([(json.dumps(deep),), (json.dumps(deep, indent=2),), (None,), ("",), ("{}",), ('{"x":"y"}',)], "j string")
    got = [r[0] for r in df.select(J.unwrap_single_key("j")).collect()]
    assert json.loads(got[0]) == json.loads(got[1]) == {"a": 1, "b": {"c": 2}}
    assert got[2:] == [None, "", "{}", "y"]


def test_no_document_is_lost(spark):
    from vigil.sources.nested_json import bad_documents
    docs = spark.createDataFrame([("a", '{"R":{"X":[{"i":1},{"i":2}]}}'), ("b", '{"R":{"X":[{"i":1},'), ("c", '{"Other":{"X":[]}}'),
                                  ("d", '{"R":{"X":"text"}}'), ("e", '{"R":{"X":[]}}'), ("f", None), ("g", '{"R":{"X":{"i":3}}}')],
                                 "source_file string, doc string")
    assert {r["source_file"] for r in records(docs, "R.X").collect()} == {"a", "g"}
    assert {r["source_file"]: r["error_reason"] for r in bad_documents(docs, "R.X").collect()} == {
        "b": "not a JSON document", "c": "root missing: R.X", "d": "root holds no records: R.X", "f": "not a JSON document"}


def test_reporter_container_that_is_no_object_is_quarantined(spark):
    m = _member("1", "A", "P", {"sioDes": "x"}, {"rel": "oops", "cms": None})
    gone = {"deputado": m["deputado"], "AtividadeDeputadoList": {}}
    df = spark.createDataFrame([(json.dumps(m),), (json.dumps(gone),), ("[1]",)], "record string")
    good, bad = flatten_activity(df)
    assert good.count() == 0
    assert sorted((r["mp_id"] or "", r["error_reason"]) for r in bad.collect()) == [
        ("", "member record is not an object"), ("1", "activity list missing or not an object"),
        ("1", "reporter container is not an object")]


def test_activity_key_hashes_the_whole_entry(spark):
    def act(**kw):
        return {"actId": "1", "actTpdesc": "V", "actNr": "5", "actSelLg": "XV", "actDtent": "2023-01-02", "actAs": "t", **kw}
    m = _member("1", "A", "P", {"sioDes": "x"}, {"actP": _w([act(), act(actDtent="2023-01-03"), act(actAs="u"), act(actId=None), act()])})
    good, _ = flatten_activity(spark.createDataFrame([(json.dumps(m),)], "record string"))
    assert good.count() == 5 and good.select("act_key").distinct().count() == 4


def _member(dep_id, name, party, status, acts):
    gp = party if isinstance(party, list) else {"gpSigla": party}
    return {"deputado": {"depId": dep_id, "depNomeParlamentar": name, "depCPDes": "Distrito",
                         "depGP": {"pt_ar_wsgode_objectos_DadosSituacaoGP": gp},
                         "depSituacao": {"pt_ar_wsgode_objectos_DadosSituacaoDeputado": status}},
            "AtividadeDeputadoList": {"pt_gov_ar_wsar_objectos_ActividadeOut": acts}}


def _w(x, name="pt_gov_ar_wsar_objectos_Out"):
    return {name: x}


def activity_doc():
    m1 = _member("10", "Ana Alfa", "P1", [{"sioDes": "Suplente"}, {"sioDes": "Efetivo"}], {
        "actP": _w([{"actId": "1", "actTpdesc": "Voto", "actNr": "5", "actSelLg": "XV",
                     "actDtent": "2023-01-02", "actAs": "  \"Quoted title\"  "},
                    {"actId": "2", "actTpdesc": "Voto", "actNr": None, "actSelLg": "XV",
                     "actDtent": "2023-01-03", "actAs": "'single'"}]),
        "audicoes": _w({"actId": "3", "actTpdesc": "Audição", "actNr": "7", "accDtaud": "2023-02-01",
                        "nomeEntidadeExterna": "Entity E"}),
        "audiencias": _w(_w({"actId": "4", "actTpdesc": "Audiência", "actNr": "8", "actLg": "XV",
                             "accDtaud": "2023-02-02"}, "inner")),
        "req": _w({"reqId": "5", "reqPerTp": "Pergunta", "reqNr": "1", "reqLg": "XV", "reqSl": "1",
                   "reqDt": "2023-03-04 10:11:12", "reqAs": "Question"}),
        "rel": {"relatoresIniciativas": _w({"iniId": "6", "iniTp": "PJL", "iniNr": "9", "iniSelLg": "XV",
                                            "iniTi": "Report"}, "pt_gov_ar_wsar_objectos_RelatoresIniciativasOut"),
                "relatoresPeticoes": _w([{"petId": "7", "petNr": "1", "petSelLgPk": "XV", "petSelNrPk": "1",
                                          "petAspet": "Petition A"},
                                         {"petId": "8", "petNr": "2", "petSelLgPk": "XV", "petSelNrPk": "1",
                                          "petAspet": "Petition B"}]),
                "relatoresOutros": _w({"x": "1", "y": "2"})},
        "cms": _w({"cmsNo": "skip me", "x": "1"}),
        "eventos": None,
        "intev": _w({"intId": "9", "tinDs": "Intervenção", "pubTp": "DAR", "pubNr": "3", "pubLg": "XV",
                     "pubSl": "1", "pubDtreu": "2023-04-05"}),
        "novidade": _w({"a": "1", "b": "2"}),
    })
    m2 = _member("11", "Bruno Beta", [{"gpSigla": "P0"}, {"gpSigla": "P2"}], {"sioDes": "Efetivo"}, {
        "audiencias": _w({"actId": "20", "actTpdesc": "Audiência", "actNr": "1", "actLg": "XV",
                          "accDtaud": "2023-05-06"}),
        "eventos": _w({"actId": "21", "tevTp": "Evento", "cmsAb": "C1", "actLg": "XV",
                       "actDtent": "2023-06-07", "actAs": "Event"}),
        "deslocacoes": _w({"actId": "22", "actTp": "Viagem", "cmsAb": "C2", "actLg": "XV",
                           "actDtdes1": "2023-07-08"}),
    })
    return {"ArrayOfAtividadeDeputado": {"AtividadeDeputado": [m1, m2]}}


def test_member_activity_flatten(spark, tmp_path):
    path = _write(tmp_path, "activity.json", activity_doc())
    recs = records(read_documents(spark, path), ACTIVITY_ROOT)
    good, bad = flatten_activity(recs)
    rows = {(r.act_type, r.act_id): r for r in good.collect()}
    assert set(rows) == {("par", "1"), ("par", "2"), ("adt", "3"), ("adc", "4"), ("req", "5"),
                         ("rin", "6"), ("rpe", "7"), ("rpe", "8"), ("int", "9"), ("adc", "20"),
                         ("eve", "21")}
    p1 = rows[("par", "1")]
    assert (p1.mp_id, p1.mp_name, p1.mp_party, p1.mp_status) == ("10", "Ana Alfa", "P1", "Efetivo")
    assert (p1.act_subtype, p1.act_dar, p1.act_date, p1.act_desc) == ("Voto", "5/XV", "2023-01-02",
                                                                      "Quoted title")
    assert rows[("par", "2")].act_dar == "None/XV" and rows[("par", "2")].act_desc == "single"
    assert rows[("adt", "3")].act_desc == "Entity E" and rows[("adt", "3")].act_dar == "7"
    assert rows[("adc", "4")].act_desc == ""          # neither key present
    assert rows[("req", "5")].act_date == "2023-03-04"
    assert rows[("req", "5")].act_dar == "1/XV/1"
    assert rows[("rin", "6")].act_dar == "9/XV" and rows[("rin", "6")].act_date == ""
    assert rows[("rpe", "7")].act_subtype == "relatores peticoes"
    assert rows[("int", "9")].act_desc == "" and rows[("int", "9")].act_dar == "DAR/3/XV/1"
    assert rows[("adc", "20")].mp_status == "Efetivo"
    assert rows[("adc", "20")].mp_party == "P2"         # party given as a list: last entry
    assert str(rows[("req", "5")].act_date_parsed) == "2023-03-04"
    reasons = sorted(r.error_reason for r in bad.collect())
    assert any(x.startswith("unknown activity type: novidade") for x in reasons)
    assert any(x.startswith("unknown activity type: relatoresOutros") for x in reasons)
    assert any(x.startswith("missing keys: actAs") for x in reasons)  # tra without actAs
    assert len(reasons) == 3


def _ini(nr, parties=None, authors=None, events=(), title="T", pag=True):
    d = {"iniNr": nr, "iniTipo": "P", "iniLeg": "XV", "iniSel": "1", "iniTitulo": title,
         "iniLinkTexto": f"https://example.org/{nr}",
         "iniEventos": {"pt_gov_ar_objectos_iniciativas_EventosOut": list(events) if len(events) != 1
                        else events[0]}}
    if parties is not None:
        d["iniAutorGruposParlamentares"] = {"pt_gov_ar_objectos_AutoresGruposParlamentaresOut":
                                            parties if len(parties) != 1 else parties[0]}
    if authors is not None:
        d["iniAutorDeputados"] = {"pt_gov_ar_objectos_iniciativas_AutoresDeputadosOut":
                                  authors if len(authors) != 1 else authors[0]}
    return d


def _pub(dt, nr, pag=None):
    p = {"pubdt": dt, "pubNr": nr, "pubTipo": "DAR II série A", "pubLeg": "XV", "pubSL": "1"}
    if pag is not None:
        p["pag"] = {"string": pag}
    return p


def test_initiative_flatten(spark, tmp_path):
    pubs_a = {"pt_gov_ar_objectos_PublicacoesOut": _pub("2023-01-05", "10", "3")}
    pubs_b = {"pt_gov_ar_objectos_PublicacoesOut": [_pub("2023-02-01", "20"), _pub("2023-02-02", "21", "7")]}
    inis = [
        _ini("1", parties=[{"GP": "PA"}], authors=[{"nome": "Ana"}],
             events=[{"fase": "Entrada", "dataFase": "2023-01-01"},
                     {"fase": "Publicação", "dataFase": "x", "publicacaoFase": pubs_a},
                     {"fase": "Votação Deliberação", "dataFase": "y", "publicacaoFase": pubs_b},
                     {"fase": "Publicação", "dataFase": "z"}],
             title="  Line one\\nline two\nline three  "),
        _ini("2", parties=[{"GP": "PA"}, {"GP": "PB"}], authors=[{"nome": "Ana"}, {"nome": "Bruno"}],
             events=[{"fase": "Entrada", "dataFase": "2023-03-01"}]),
        _ini("3", events=[{"fase": "Publicação", "dataFase": "w", "publicacaoFase": pubs_a}]),
    ]
    doc = {"ArrayOfPt_gov_ar_objectos_iniciativas_DetalhePesquisaIniciativasOut": {
        "pt_gov_ar_objectos_iniciativas_DetalhePesquisaIniciativasOut": inis}}
    recs = records(read_documents(spark, _write(tmp_path, "ini.json", doc)), INITIATIVE_ROOT)
    rows = {r.id: r for r in flatten_initiatives(recs).collect()}
    r1, r2, r3 = rows["1/P/XV/1"], rows["2/P/XV/1"], rows["3/P/XV/1"]
    assert r1.party == "PA" and r1.title == "Line one line two line three"
    assert r1.entry_date == "2023-01-01"
    assert r1.publication_date == "2023-02-01 2023-02-02"          # last event with data wins
    assert r1.dar_ref == "20/II-A/XV/1 7/21/II-A/XV/1"
    assert (r1.authors, r1.number_authors) == ("Ana", 1)
    assert r2.party == "PA PB" and r2.authors == "Ana, Bruno" and r2.number_authors == 2
    assert r2.publication_date is None and r2.dar_ref is None
    assert r3.party is None and r3.authors == "" and r3.number_authors == 0
    assert r3.entry_date is None and r3.dar_ref == "3/10/II-A/XV/1"


from hypothesis import given, settings
from hypothesis import strategies as st

_TYPES = {"actP": ("par", {"actId": "1", "actTpdesc": "s", "actNr": "1", "actSelLg": "L",
                           "actDtent": "2023-01-01", "actAs": "d"}),
          "req": ("req", {"reqId": "2", "reqPerTp": "s", "reqNr": "1", "reqLg": "L", "reqSl": "1",
                          "reqDt": "2023-01-01 00:00:00", "reqAs": "d"}),
          "eventos": ("eve", {"actId": "3", "tevTp": "s", "cmsAb": "c", "actLg": "L",
                              "actDtent": "2023-01-01", "actAs": "d"})}


@settings(max_examples=3, deadline=None)
@given(st.lists(st.dictionaries(st.sampled_from(sorted(_TYPES) + ["cms"]),
                                st.tuples(st.integers(0, 4), st.booleans()), max_size=4),
                min_size=1, max_size=6))
def test_flattened_rows_equal_sum_of_sizes(spark, members):
    """Property: rows out = Σ over non-skipped, non-empty types of the number
    of records, a bare object counting as one (0 records = JSON null)."""
    docs, expected = [], 0
    for i, types in enumerate(members):
        acts = {}
        for key, (n, wrap2) in types.items():
            rec = _TYPES.get(key, ("x", {"a": "1", "b": "2"}))[1]
            payload = None if n == 0 else (rec if n == 1 else [rec] * n)
            w = _w(payload)
            acts[key] = (None if payload is None else (_w(w, "outer") if wrap2 else w))
            if key != "cms":
                expected += n
        docs.append(_member(str(i), f"M{i}", "P", {"sioDes": "x"}, acts))
    df = spark.createDataFrame([(json.dumps(d),) for d in docs], "record string")
    good, bad = flatten_activity(df)
    assert good.count() == expected and bad.count() == 0


def test_initiative_quarantine(spark):
    from vigil.operators.initiative import split_initiatives
    ok = _ini("1", events=[{"fase": "Entrada", "dataFase": "2023-01-01"}])
    no_title = dict(ok)
    no_title.pop("iniTitulo")
    no_events = dict(ok)
    no_events["iniEventos"] = {"other": []}
    df = spark.createDataFrame([(json.dumps(x),) for x in (ok, no_title, no_events)] + [("[1]",)],
                               "record string")
    good, bad = split_initiatives(df)
    assert [r.id for r in good.collect()] == ["1/P/XV/1"]
    assert sorted(r.error_reason for r in bad.collect()) == [
        "missing events list", "missing keys: iniTitulo", "record is not an object"]


def test_empty_list_payload_has_no_rows_and_scalar_is_quarantined(spark):
    doc = _member("1", "X", "P", {"sioDes": "s"}, {
        "actP": _w([]),
        "req": _w("not a record"),
        "eventos": _w({"actId": "9", "tevTp": "E", "cmsAb": "c", "actLg": "L", "actDtent": "2023-01-01",
                       "actAs": "d"})})
    df = spark.createDataFrame([(json.dumps(doc),)], "record string")
    good, bad = flatten_activity(df)
    assert [r.act_id for r in good.collect()] == ["9"]
    assert [(r.src_key, r.error_reason) for r in bad.collect()] == [("req", "empty or malformed activity payload")]


def test_member_without_activity_list_is_quarantined(spark):
    ok = _member("1", "A", "P", {"sioDes": "s"}, {})               # empty list: nothing, no problem
    broken = _member("2", "B", "P", {"sioDes": "s"}, {})
    broken.pop("AtividadeDeputadoList")
    listy = _member("3", "C", "P", {"sioDes": "s"}, {})
    listy["AtividadeDeputadoList"]["pt_gov_ar_wsar_objectos_ActividadeOut"] = [1, 2]
    df = spark.createDataFrame([(json.dumps(x),) for x in (ok, broken, listy)], "record string")
    good, bad = flatten_activity(df)
    assert good.count() == 0
    assert sorted((r.mp_id, r.error_reason) for r in bad.collect()) == [
        ("2", "activity list missing or not an object"), ("3", "activity list missing or not an object")]


def test_clean_html_option(spark):
    doc = _member("1", "X", "P", {"sioDes": "s"}, {
        "actP": _w({"actId": "1", "actTpdesc": "t", "actNr": "1", "actSelLg": "L", "actDtent": "2023-01-01",
                    "actAs": '"<p>Voto de pesar &amp; louvor: S&#227;o <b>Tom&eacute</b></p>"'})})
    df = spark.createDataFrame([(json.dumps(doc),)], "record string")
    raw = flatten_activity(df)[0].first().act_desc
    clean = flatten_activity(df, clean_html=True)[0].first().act_desc
    assert raw.startswith("<p>Voto") and clean == "Voto de pesar & louvor: São Tom&eacute"
    ini = _ini("1", events=[{"fase": "Entrada", "dataFase": "d"}], title="<i>Projeto</i> &#8211; lei")
    idf = spark.createDataFrame([(json.dumps(ini),)], "record string")
    assert flatten_initiatives(idf, clean_html=True).first().title == "Projeto – lei"

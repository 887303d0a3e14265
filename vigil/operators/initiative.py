"""Initiative flattening: one row per initiative record with its id, parties,
title, dates and publication reference folded out of nested event lists.

All folds run on the record's own arrays (``filter``/``transform``/
``array_join``/``try_element_at``), so a record is processed where it lies:
no shuffle and no Python.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vigil.functions.arrays import last_matching
from vigil.functions.jsonx import is_array, json_records
from vigil.functions.text import (dar_category, decode_entities, format_id, strip, strip_html,
                                  title_clean)

INITIATIVE_ROOT = ("ArrayOfPt_gov_ar_objectos_iniciativas_DetalhePesquisaIniciativasOut"
                   ".pt_gov_ar_objectos_iniciativas_DetalhePesquisaIniciativasOut")
# Phase names.
ENTRY_PHASE = "Entrada"
PUBLICATION_PHASES = ["Publicação", "Votação Deliberação"]


def _fmt(x: Column, null_text: str = "None") -> Column:
    return F.coalesce(x, F.lit(null_text))


# The initiative fields read (polymorphic parts kept as text).
INITIATIVE_SCHEMA = (
    "struct<iniNr: string, iniTipo: string, iniLeg: string, iniSel: string, iniTitulo: string, "
    "iniLinkTexto: string, "
    "iniAutorGruposParlamentares: struct<pt_gov_ar_objectos_AutoresGruposParlamentaresOut: string>, "
    "iniAutorDeputados: struct<pt_gov_ar_objectos_iniciativas_AutoresDeputadosOut: string>, "
    "iniEventos: struct<pt_gov_ar_objectos_iniciativas_EventosOut: string>>")


def _k(m: Column, key: str) -> Column:
    return F.element_at(m, F.lit(key))


def _pub_ref(p: Column) -> Column:
    pag = _k(p, "pag")
    pages = F.when(pag.isNotNull(), F.concat(_fmt(F.get_json_object(pag, "$.string")), F.lit("/"))) \
             .otherwise(F.lit(""))
    return F.concat(pages, _fmt(_k(p, "pubNr")), F.lit("/"), _fmt(dar_category(_k(p, "pubTipo"))),
                    F.lit("/"), _fmt(_k(p, "pubLeg")), F.lit("/"), _fmt(_k(p, "pubSL")))


# Keys every initiative record, event and publication must carry.
REQUIRED_KEYS = ["iniNr", "iniTipo", "iniLeg", "iniSel", "iniTitulo", "iniLinkTexto", "iniEventos"]
PUBLICATION_KEYS = ["pubdt", "pubTipo", "pubNr", "pubLeg", "pubSL"]


def _lacking(maps: str, keys: list[str], prefix: str) -> Column:
    """Names of the keys that some map of the array lacks (a null value is there)."""
    wanted = F.array(*[F.lit(k) for k in keys])
    return F.transform(F.array_distinct(F.flatten(F.transform(F.coalesce(F.col(maps), F.array().cast("array<map<string,string>>")),
                                                              lambda m: F.array_except(wanted, F.map_keys(m))))),
                       lambda k: F.concat(F.lit(prefix), k))


def tag_initiatives(records: DataFrame, record: str = "record",
                    keep: tuple[str, ...] = (), clean_html: bool = False) -> DataFrame:
    """Initiative records -> one row each, with ``error_reason`` where a mandatory
    key is missing (at the top, or of an event, party, author or publication
    that is read). The record is parsed once into a
    struct; the object-or-array parts (parties, authors, events, publications)
    are parsed once each into ``array<map<string,string>>``; each stage is
    its own projection so no parse is repeated. With ``clean_html`` the title
    loses HTML tags and its character references are decoded."""
    r = records.select(*keep, F.col(record).alias("_raw"), F.from_json(record, INITIATIVE_SCHEMA).alias("_r"),
                       F.json_object_keys(F.col(record)).alias("_keys"))
    parties_raw = F.col("_r")["iniAutorGruposParlamentares"]["pt_gov_ar_objectos_AutoresGruposParlamentaresOut"]
    r = r.select(*keep, "_raw", "_keys", "_r",
                 json_records(F.col("_r")["iniEventos"]["pt_gov_ar_objectos_iniciativas_EventosOut"]).alias("_ev"),
                 json_records(parties_raw).alias("_gp"), is_array(parties_raw).alias("_gp_list"),
                 json_records(F.col("_r")["iniAutorDeputados"]["pt_gov_ar_objectos_iniciativas_AutoresDeputadosOut"])
                 .alias("_au"))
    entry = last_matching("_ev", lambda e: _k(e, "fase") == ENTRY_PHASE)
    pub_event = last_matching("_ev", lambda e: _k(e, "fase").isin(PUBLICATION_PHASES)
                              & _k(e, "publicacaoFase").isNotNull())
    r = r.select(*keep, "_raw", "_keys", "_r", "_ev", "_gp", "_gp_list", "_au", _k(entry, "dataFase").alias("entry_date"),
                 pub_event.isNotNull().alias("_has_pub"),
                 json_records(F.get_json_object(_k(pub_event, "publicacaoFase"),
                                                "$.pt_gov_ar_objectos_PublicacoesOut")).alias("_pubs"))
    x = F.col("_r")
    authors = F.coalesce(F.col("_au"), F.array().cast("array<map<string,string>>"))
    party = (F.when(F.col("_gp_list"),
                    strip(F.array_join(F.transform("_gp", lambda g: _fmt(_k(g, "GP"))), " ")))
              .otherwise(_k(F.try_element_at("_gp", F.lit(1)), "GP")))
    missing = F.array_except(F.array(*[F.lit(k) for k in REQUIRED_KEYS]), F.coalesce("_keys", F.array().cast("array<string>")))
    inner = F.concat(_lacking("_ev", ["fase"], "iniEventos."), _lacking("_gp", ["GP"], "iniAutorGruposParlamentares."),
                     _lacking("_au", ["nome"], "iniAutorDeputados."), _lacking("_pubs", PUBLICATION_KEYS, "publicacaoFase."))
    lists = F.concat(missing, inner)
    reason = (F.when(F.col("_keys").isNull(), F.lit("record is not an object"))
               .when(F.size(missing) > 0, F.concat(F.lit("missing keys: "), F.array_join(missing, ",")))
               .when(F.col("_ev").isNull(), F.lit("missing events list"))
               .when(F.size(lists) > 0, F.concat(F.lit("missing keys: "), F.array_join(lists, ","))))
    # an explode that no filter crosses: the record is parsed once for both outcomes
    r = r.withColumn("error_reason", F.explode(F.array(reason)))
    return r.select(
        *keep,
        format_id(x["iniNr"], x["iniTipo"], x["iniLeg"], x["iniSel"]).alias("id"),
        party.alias("party"),
        (decode_entities(strip_html(title_clean(x["iniTitulo"]))) if clean_html
         else title_clean(x["iniTitulo"])).alias("title"),
        x["iniLinkTexto"].alias("text_url"),
        "entry_date",
        F.when(F.col("_has_pub"),
               strip(F.array_join(F.transform("_pubs", lambda p: _fmt(_k(p, "pubdt"))), " ")))
         .alias("publication_date"),
        F.when(F.col("_has_pub"), strip(F.array_join(F.transform("_pubs", _pub_ref), " "))).alias("dar_ref"),
        F.array_join(F.transform(authors, lambda a: _k(a, "nome")), ", ").alias("authors"),
        F.size(authors).cast("int").alias("number_authors"),
        F.col("_raw").alias(record), "error_reason")


def flatten_initiatives(records: DataFrame, record: str = "record",
                        keep: tuple[str, ...] = (), clean_html: bool = False) -> DataFrame:
    """Every record flattened as far as it goes, also those that lack mandatory
    keys; ``split_initiatives`` keeps those apart."""
    return tag_initiatives(records, record, keep, clean_html).drop(record, "error_reason")


def split_initiatives(records: DataFrame, record: str = "record", keep: tuple[str, ...] = (),
                      clean_html: bool = False) -> tuple[DataFrame, DataFrame]:
    """(initiatives, quarantine): records lacking a mandatory key go to the
    quarantine with a reason instead of failing the run. To write both, store
    ``tag_initiatives`` once and split that with ``split_tagged``."""
    return split_tagged(tag_initiatives(records, record, keep, clean_html), record, keep)


def split_tagged(tagged: DataFrame, record: str = "record", keep: tuple[str, ...] = ()) -> tuple[DataFrame, DataFrame]:
    good = tagged.where(F.col("error_reason").isNull()).drop(record, "error_reason")
    return good, tagged.where(F.col("error_reason").isNotNull()).select(*keep, record, "error_reason")

"""Member-activity flattening: nested, shape-unstable member records -> one
row per activity, plus a quarantine of records that cannot be mapped.

Each member record carries a map ``activity type -> payload``. Payloads are
wrapped in single-key wrapper objects and hold a bare object (one activity)
or an array (several). The flattening is a fixed sequence of narrow
transformations on rows (explode the type map, drop skipped and empty types,
explode the reporter sub-map, unwrap, normalise object-or-array, explode,
map fields by type) — no shuffle, no per-record Python, and every type goes
through the same CASE expressions instead of one union branch per type.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vigil.functions.jsonx import is_object, json_array, json_map, unwrap_records
from vigil.functions.text import decode_entities, dequote, first_token, strip_html
from vigil.operators.reconcile import Counts, rows

# Source key -> activity code for the renamed types.
TYPE_CODES = {"actP": "par", "audicoes": "adt", "audiencias": "adc",
              "deslocacoes": "tra", "eventos": "eve", "intev": "int"}
# Codes kept under their own name.
KEPT_CODES = ["ini", "req", "rin", "rpe", "rie", "rcp"]
# Source keys that are not activities.
SKIP_KEYS = ["dadosLegisDeputado", "cms", "dlE", "dlP", "parlamentoJovens", "scgt", "gpa"]
# The reporter container and its four sub-keys.
REL_KEY = "rel"
REL_CODES = {"relatoresIniciativas": "rin", "relatoresPeticoes": "rpe",
             "relatoresIniEuropeias": "rie", "relatoresContasPublicas": "rcp"}

# Per-code field names.
#   id: source id field; subtype: field or ("const", text); dar: fields joined
#   by '/'; date: field, None for '', or ("first_token", field);
#   desc: field, or ("first_of", [fields]) for the first present one.
FIELD_MAP = {
    "par": dict(id="actId", subtype="actTpdesc", dar=["actNr", "actSelLg"], date="actDtent", desc="actAs"),
    "adt": dict(id="actId", subtype="actTpdesc", dar=["actNr"], date="accDtaud",
                desc=("first_of", ["actAs", "nomeEntidadeExterna"])),
    "adc": dict(id="actId", subtype="actTpdesc", dar=["actNr", "actLg"], date="accDtaud",
                desc=("first_of", ["actAs", "nomeEntidadeExterna"])),
    "tra": dict(id="actId", subtype="actTp", dar=["cmsAb", "actLg"], date="actDtdes1", desc="actAs"),
    "eve": dict(id="actId", subtype="tevTp", dar=["cmsAb", "actLg"], date="actDtent", desc="actAs"),
    "ini": dict(id="iniId", subtype="iniTpdesc", dar=["iniNr", "iniTp", "iniSelLg", "iniSelNr"],
                date=None, desc="iniTi"),
    "int": dict(id="intId", subtype="tinDs", dar=["pubTp", "pubNr", "pubLg", "pubSl"], date="pubDtreu",
                desc=("first_of", ["intSu"])),
    "rin": dict(id="iniId", subtype="iniTp", dar=["iniNr", "iniSelLg"], date=None, desc="iniTi"),
    "rpe": dict(id="petId", subtype=("const", "relatores peticoes"),
                dar=["petNr", "petSelLgPk", "petSelNrPk"], date=None, desc="petAspet"),
    "rie": dict(id="ineId", subtype=("const", "relatores iniciativas europeias"), dar=["leg"],
                date="ineDataRelatorio", desc="ineTitulo"),
    "rcp": dict(id="actId", subtype=("const", "relatores contas publicas"), dar=[], date=None,
                desc="actAs"),
    "req": dict(id="reqId", subtype="reqPerTp", dar=["reqNr", "reqLg", "reqSl"],
                date=("first_token", "reqDt"), desc="reqAs"),
}

# Member record layout (only the fields read). The party and
# status elements may be object or array, so they are kept as raw text.
MEMBER_SCHEMA = (
    "struct<deputado: struct<depId: string, depNomeParlamentar: string, depCPDes: string, "
    "depGP: struct<pt_ar_wsgode_objectos_DadosSituacaoGP: string>, "
    "depSituacao: struct<pt_ar_wsgode_objectos_DadosSituacaoDeputado: string>>, "
    "AtividadeDeputadoList: struct<pt_gov_ar_wsar_objectos_ActividadeOut: map<string, string>>>")
ACTIVITY_ROOT = "ArrayOfAtividadeDeputado.AtividadeDeputado"

DATE_FORMATS = ["yyyy-MM-dd", "dd/MM/yyyy HH:mm:ss", "dd/MM/yyyy", "yyyy-MM-dd HH:mm:ss"]


def parse_date(col) -> Column:
    """Typed date from the text formats seen in the sources; NULL otherwise."""
    c = F.col(col) if isinstance(col, str) else col
    c = F.when(F.length(c) > 0, c)
    return F.coalesce(*[F.try_to_timestamp(c, F.lit(f)).cast("date") for f in DATE_FORMATS])


def _required(spec: dict) -> list[str]:
    req = [spec["id"]] + list(spec["dar"])
    if isinstance(spec["subtype"], str):
        req.append(spec["subtype"])
    d = spec["date"]
    if isinstance(d, str):
        req.append(d)
    elif isinstance(d, tuple):
        req.append(d[1])
    if isinstance(spec["desc"], str):
        req.append(spec["desc"])
    return req


MAX_DAR_FIELDS = max(len(v["dar"]) for v in FIELD_MAP.values())
MAX_DESC_FIELDS = max(len(v["desc"][1]) if isinstance(v["desc"], tuple) else 1 for v in FIELD_MAP.values())
FIRST_OF_CODES = [k for k, v in FIELD_MAP.items() if isinstance(v["desc"], tuple)]
TOKEN_DATE_CODES = [k for k, v in FIELD_MAP.items() if isinstance(v["date"], tuple)]


def _lit_map(d: dict) -> Column:
    kv = []
    for k, v in d.items():
        kv += [F.lit(k), F.array(*[F.lit(x) for x in v]) if isinstance(v, list) else F.lit(v)]
    return F.create_map(*kv)


def _spec_maps() -> dict[str, Column]:
    """FIELD_MAP as literal maps keyed by code, so every output field is one
    lookup expression instead of a CASE over all codes."""
    fm = FIELD_MAP
    return {
        "id": _lit_map({k: v["id"] for k, v in fm.items()}),
        "subtype": _lit_map({k: v["subtype"] for k, v in fm.items() if isinstance(v["subtype"], str)}),
        "subtype_const": _lit_map({k: v["subtype"][1] for k, v in fm.items()
                                   if isinstance(v["subtype"], tuple)}),
        "dar": _lit_map({k: list(v["dar"]) for k, v in fm.items()}),
        "date": _lit_map({k: (v["date"][1] if isinstance(v["date"], tuple) else v["date"])
                          for k, v in fm.items() if v["date"] is not None}),
        "desc": _lit_map({k: (list(v["desc"][1]) if isinstance(v["desc"], tuple) else [v["desc"]])
                          for k, v in fm.items()}),
        "required": _lit_map({k: _required(v) for k, v in fm.items()}),
    }


def member_fields(parsed: str = "_r") -> list[Column]:
    d = F.col(parsed)["deputado"]
    st = json_array(d["depSituacao"]["pt_ar_wsgode_objectos_DadosSituacaoDeputado"])
    return [d["depId"].alias("mp_id"), d["depNomeParlamentar"].alias("mp_name"),
            F.get_json_object(F.try_element_at(json_array(d["depGP"]["pt_ar_wsgode_objectos_DadosSituacaoGP"]),
                                               F.lit(-1)), "$.gpSigla").alias("mp_party"),
            F.get_json_object(F.try_element_at(st, F.lit(-1)), "$.sioDes").alias("mp_status")]


def _activity_map(parsed: str) -> Column:
    return F.col(parsed)["AtividadeDeputadoList"]["pt_gov_ar_wsar_objectos_ActividadeOut"]


def explode_activity_groups(members: DataFrame, record: str = "record",
                            keep: tuple[str, ...] = (), counts: Counts | None = None) -> DataFrame:
    """(member fields, problem, act_type, payload) per non-empty, non-skipped type;
    the reporter container is split into its four codes (unknown sub-keys get
    ``act_type`` NULL and ``src_key`` for the quarantine). A member whose
    activity list is missing or not an object, on which the source stopped,
    keeps one row with its ``problem``; an empty list is none. Each member
    record is parsed once."""
    parsed = members.select(*keep, F.from_json(record, MEMBER_SCHEMA).alias("_r"),
                            F.coalesce(is_object(record), F.lit(False)).alias("_object"))
    problem = F.when(~F.col("_object"), F.lit("member record is not an object")) \
        .otherwise(F.lit("activity list missing or not an object"))
    none = F.lit(None).cast("string")
    entries = F.coalesce(F.transform(F.map_entries(_activity_map("_r")), lambda e: F.struct(
        e["key"].alias("k"), e["value"].alias("v"), none.alias("problem"))),
        F.array(F.struct(none.alias("k"), none.alias("v"), problem.alias("problem"))))
    m = parsed.select(*keep, *member_fields("_r"), F.explode(entries).alias("_e"))
    m = m.select(*[c for c in m.columns if c != "_e"], F.col("_e.k").alias("src_key"), F.col("_e.v").alias("payload"),
                 F.col("_e.problem").alias("problem"))
    skipped = F.col("problem").isNull() & F.col("src_key").isin(SKIP_KEYS)
    if counts:
        m = counts.on(m, "entries", entries=rows(), unreadable=F.count_if(F.col("problem").isNotNull()), skipped=F.count_if(skipped),
                      null=F.count_if(F.col("problem").isNull() & ~F.col("src_key").isin(SKIP_KEYS) & F.col("payload").isNull()))
    m = m.where(F.col("problem").isNotNull() | (F.col("payload").isNotNull() & ~F.col("src_key").isin(SKIP_KEYS)))
    if counts:
        m = counts.on(m, "kept", entries=rows())
    # The reporter container holds up to four typed sub-containers: its
    # entries are spread into (sub key, payload) pairs in the same explode
    # that carries every other type through unchanged, so the upstream is
    # read once (no union of two branches). A container that is no object
    # stays whole, for the quarantine.
    pairs = F.coalesce(
        F.when(F.col("src_key") == REL_KEY, F.transform(
            F.map_entries(json_map("payload")), lambda e: F.struct(e["key"].alias("k"), e["value"].alias("v"), F.lit(True).alias("rel")))),
        F.array(F.struct(F.col("src_key").alias("k"), F.col("payload").alias("v"), (F.col("src_key") == REL_KEY).alias("rel"))))
    keep_cols = [c for c in m.columns if c not in ("src_key", "payload")]
    x = m.select(*keep_cols, F.explode(pairs).alias("_p"))
    type_map = F.create_map(*sum(([F.lit(k), F.lit(v)] for k, v in TYPE_CODES.items()), []))
    rel_map = F.create_map(*sum(([F.lit(k), F.lit(v)] for k, v in REL_CODES.items()), []))
    k = F.col("_p")["k"]
    code = F.when(F.col("_p")["rel"], F.try_element_at(rel_map, k)) \
            .otherwise(F.coalesce(F.try_element_at(type_map, k), F.when(k.isin(KEPT_CODES), k)))
    return (x.select(*keep_cols, k.alias("src_key"), F.col("_p")["v"].alias("payload"),
                     code.alias("act_type"))
             .where(F.col("problem").isNotNull() | F.col("payload").isNotNull()))


def _entry_hash(*cols: str) -> Column:
    """Hash of the values in order; NULL differs from every text, and lengths keep
    neighbouring values apart."""
    marked = [F.coalesce(F.concat(F.length(c).cast("string"), F.lit(":"), F.col(c)), F.lit("~")) for c in cols]
    return F.sha2(F.concat(*marked), 256)


def tag_activity(members: DataFrame, record: str = "record", keep: tuple[str, ...] = (),
                 null_text: str | None = "None", clean_html: bool = False, counts: Counts | None = None) -> DataFrame:
    """Member records -> one table of activities and quarantined entries: a row is
    an activity where ``error_reason`` is NULL. See ``flatten_activity``. ``counts`` gets the rows
    of every step, and per code with alternative description keys how many records have none."""
    if counts:
        members = counts.on(members, "members", members=rows())
    groups = unwrap_records(explode_activity_groups(members, record, keep, counts), "payload", "_recs")
    if counts:
        size = F.coalesce(F.size("_recs"), F.lit(1))
        groups = counts.on(groups, "groups", groups=rows(), empty=F.count_if(size == 0), records=F.sum(size))
    acts = groups.select(*[c for c in groups.columns if c not in ("payload", "_recs")],
                         # an empty list has no activities; a payload that is neither
                         # object nor list keeps one NULL row for the quarantine
                         F.posexplode(F.coalesce(F.col("_recs"), F.array(
                             F.lit(None).cast("map<string,string>")))).alias("act_pos", "_m"))
    m = F.col("_m")
    code = F.col("act_type")
    spec = _spec_maps()

    def field_of(table: Column) -> Column:
        # value of the field this code reads; NULL when the code has none
        return F.try_element_at(m, F.try_element_at(table, code))

    def nth_value(table: Column, i: int) -> tuple[Column, Column]:
        # (this code has an i-th field, value of that field); fixed positions
        # keep the expressions in generated code (no lambda evaluation)
        fields = F.try_element_at(table, code)
        return (F.coalesce(F.size(fields), F.lit(0)) >= i,
                F.try_element_at(m, F.try_element_at(fields, F.lit(i))))

    dar_parts = [nth_value(spec["dar"], i) for i in range(1, MAX_DAR_FIELDS + 1)]
    if null_text is None:
        any_null = F.lit(False)
        for has, v in dar_parts:
            any_null = any_null | (has & v.isNull())
        dar = F.when(any_null, F.lit(None).cast("string")).otherwise(
            F.concat_ws("/", *[F.when(has, v) for has, v in dar_parts]))
    else:
        dar = F.concat_ws("/", *[F.when(has, F.coalesce(v, F.lit(null_text))) for has, v in dar_parts])
    first_desc = F.coalesce(*[nth_value(spec["desc"], i)[1] for i in range(1, MAX_DESC_FIELDS + 1)])
    desc = F.when(code.isin(FIRST_OF_CODES), F.coalesce(first_desc, F.lit(""))).otherwise(first_desc)
    date = (F.when(code.isin(TOKEN_DATE_CODES), first_token(field_of(spec["date"])))
             .when(F.try_element_at(spec["date"], code).isNotNull(), field_of(spec["date"]))
             .otherwise(F.lit("")))
    required = F.coalesce(F.try_element_at(spec["required"], code), F.array().cast("array<string>"))
    base = [c for c in acts.columns if c not in ("act_pos", "src_key", "_m")]
    typed = acts.select(
        *base, "src_key", "_m", "act_pos",
        field_of(spec["id"]).alias("act_id"),
        F.coalesce(field_of(spec["subtype"]), F.try_element_at(spec["subtype_const"], code))
         .alias("act_subtype"),
        dar.alias("act_dar"),
        date.alias("act_date"),
        (decode_entities(strip_html(dequote(desc))) if clean_html else dequote(desc)).alias("act_desc"),
        F.array_except(required, F.coalesce(F.map_keys(m), F.array().cast("array<string>")))
         .alias("_missing"))
    reason = (F.when(F.col("problem").isNotNull(), F.col("problem"))
               .when(code.isNull() & (F.col("src_key") == REL_KEY), F.lit("reporter container is not an object"))
               .when(code.isNull(), F.concat(F.lit("unknown activity type: "), F.col("src_key")))
               .when(m.isNull(), F.lit("empty or malformed activity payload"))
               .when(F.size("_missing") > 0,
                     F.concat(F.lit("missing keys: "), F.array_join("_missing", ","))))
    # an explode that no filter crosses: the reason is worked out once per entry
    judged = typed.withColumn("error_reason", F.explode(F.array(reason)))
    if counts:
        good = F.col("error_reason").isNull()
        judged = counts.on(judged, "records", records=rows(), activities=F.count_if(good), quarantined=F.count_if(~good),
                           **{f"no_description_{k}": F.count_if(good & (F.col("act_type") == k) & (F.col("act_desc") == "")
                                                                & F.coalesce(*[F.element_at("_m", F.lit(x)) for x in FIELD_MAP[k]["desc"][1]]).isNull())
                              for k in FIRST_OF_CODES})
    return (judged
            .select(*keep, "mp_id", "mp_name", "mp_party", "mp_status", "src_key", "act_id", "act_type",
                    "act_subtype", "act_dar", "act_date", "act_desc",
                    parse_date("act_date").alias("act_date_parsed"),
                    _entry_hash("act_type", "act_id", "act_subtype", "act_dar", "act_date", "act_desc").alias("act_key"),
                    F.to_json("_m").alias("act"), "error_reason"))


def split_activity(tagged: DataFrame, keep: tuple[str, ...] = ()) -> tuple[DataFrame, DataFrame]:
    """(activities, quarantine) of a tagged table, which may have been stored."""
    good = (tagged.where(F.col("error_reason").isNull())
            .select(*keep, "mp_id", "mp_name", "mp_party", "mp_status", "act_id", "act_type", "act_subtype", "act_dar",
                    "act_date", "act_desc", "act_date_parsed", "act_key"))
    bad = (tagged.where(F.col("error_reason").isNotNull())
           .select(*keep, "mp_id", "mp_name", "src_key", "act_type", "act", "error_reason"))
    return good, bad


def flatten_activity(members: DataFrame, record: str = "record", keep: tuple[str, ...] = (),
                     null_text: str | None = "None",
                     clean_html: bool = False) -> tuple[DataFrame, DataFrame]:
    """Member records -> (activities, quarantine).

    ``null_text`` is what a NULL part of ``act_dar`` is written as ('None',
    as string formatting produced; None gives NULL ids instead). With
    ``clean_html`` the description loses HTML tags and its character
    references are decoded. To write both, store ``tag_activity`` once and
    split that."""
    return split_activity(tag_activity(members, record, keep, null_text, clean_html), keep)

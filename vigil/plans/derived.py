"""Nested documents derived from the driver tables, in the source shapes.

The correctness driver has flat tables only. These builders pack them into
the shapes the parsers read (XML-derived JSON: single element = bare object,
several = array; single-key wrapper objects; type keys as data), so the
parsers run on data whose size grows with the tables. Packing groups by
order key (at most a handful of lineitems per order), never by a hot key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vigil.plans.tables import load


def jstr(c: Column) -> Column:
    """JSON string literal of a column value (escaped, quoted); NULL -> null."""
    return F.coalesce(F.regexp_replace(F.to_json(F.array(c.cast("string"))), r"^\[|\]$", ""),
                      F.lit("null"))


def qstr(c: Column) -> Column:
    """JSON string of a value that needs no escaping (digits, dates, flags)."""
    return F.concat(F.lit('"'), c.cast("string"), F.lit('"'))


def obj_or_array(items: Column) -> Column:
    """Array of JSON texts -> bare object when it has one element, else array."""
    return F.when(F.size(items) == 1, items.getItem(0)) \
            .otherwise(F.concat(F.lit("["), F.array_join(items, ","), F.lit("]")))


def _obj(*kv) -> Column:
    """JSON object text from (key, json_text_column) pairs."""
    parts = []
    for i, (k, v) in enumerate(kv):
        parts += [F.lit(("," if i else "") + f'"{k}":'), v]
    return F.concat(F.lit("{"), *parts, F.lit("}"))


def order_item_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(doc) per order: {"order": k, "items": {"Item": obj-or-array of lineitems}}."""
    li = load(spark, sf_dir, "lineitem")
    rec = F.to_json(F.struct("l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_returnflag"))
    g = li.groupBy("l_orderkey").agg(F.collect_list(rec).alias("items"))
    return g.select(_obj(("order", F.col("l_orderkey").cast("string")),
                         ("items", _obj(("Item", obj_or_array(F.col("items")))))).alias("doc"))


def member_activity_records(spark: SparkSession, sf_dir: str,
                            no_desc_status: str | None = None) -> DataFrame:
    """(record) per order, shaped like a member-activity record.

    member = order (id, 'Cust#<custkey>', party = priority, status list when
    the order status is F); activities = its lineitems, keyed by return flag:
    A -> 'actP', N -> 'req', R -> reporter container 'rel' /
    'relatoresIniciativas'; plus a skipped 'cms' entry and an empty 'eventos'.
    'actP' records of lineitems whose status equals ``no_desc_status`` lack
    their mandatory description key (records the parser must quarantine).
    """
    li = load(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity",
        "l_returnflag", "l_linestatus", "l_shipdate")
    pa = load(spark, sf_dir, "part").select("p_partkey", "p_name")
    j = li.join(pa, li.l_partkey == pa.p_partkey)
    day = F.to_date("l_shipdate").cast("string")
    s = lambda c: F.col(c).cast("string")
    par = F.to_json(F.struct(s("l_partkey").alias("actId"), F.col("l_linestatus").alias("actTpdesc"),
                             s("l_linenumber").alias("actNr"), s("l_suppkey").alias("actSelLg"),
                             day.alias("actDtent"),
                             (F.concat(F.lit('"'), F.col("p_name"), F.lit('"')) if no_desc_status is None
                              else F.when(F.col("l_linestatus") != no_desc_status,
                                          F.concat(F.lit('"'), F.col("p_name"), F.lit('"')))).alias("actAs")))
    req = F.to_json(F.struct(s("l_partkey").alias("reqId"), F.col("l_linestatus").alias("reqPerTp"),
                             s("l_linenumber").alias("reqNr"), s("l_suppkey").alias("reqLg"),
                             F.col("l_quantity").cast("long").cast("string").alias("reqSl"),
                             F.concat(day, F.lit(" 10:00:00")).alias("reqDt"),
                             F.concat(F.lit("  "), F.col("p_name"), F.lit(" ")).alias("reqAs")))
    rin = F.to_json(F.struct(s("l_partkey").alias("iniId"), F.col("l_linestatus").alias("iniTp"),
                             s("l_linenumber").alias("iniNr"), s("l_suppkey").alias("iniSelLg"),
                             F.concat(F.lit("'"), F.col("p_name"), F.lit("'")).alias("iniTi")))
    rf = F.col("l_returnflag")
    rec = F.when(rf == "A", par).when(rf == "N", req).otherwise(rin)
    o = load(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderpriority", "o_orderstatus")
    # one grouping per order (the join output is already clustered by order key)
    per_order = (j.join(o, j.l_orderkey == o.o_orderkey)
                  .groupBy("o_orderkey", "o_custkey", "o_orderpriority", "o_orderstatus")
                  .agg(F.collect_list(F.struct(rf.alias("rf"), rec.alias("rec"))).alias("recs")))

    def typed(flag: str) -> Column:
        return F.filter("recs", lambda x: x["rf"] == flag)["rec"]

    def entry(flag: str, key: str, wrap) -> Column:
        items = typed(flag)
        return F.when(F.size(items) > 0, F.concat(F.lit(f'"{key}":'), wrap(obj_or_array(items))))

    entries = F.array_compact(F.array(
        entry("A", "actP", lambda p: _obj(("pt_gov_ar_wsar_objectos_ActividadesOut", p))),
        entry("N", "req", lambda p: _obj(("pt_gov_ar_wsar_objectos_RequerimentosOut", p))),
        entry("R", "rel", lambda p: _obj(("relatoresIniciativas", _obj(
            ("pt_gov_ar_wsar_objectos_RelatoresIniciativasOut", p)))))))
    fixed = F.array(F.lit('"cms":{"pt_gov_ar_wsar_objectos_CmsOut":{"x":"1"}}'), F.lit('"eventos":null'))
    amap = F.concat(F.lit("{"), F.array_join(F.concat(entries, fixed), ","), F.lit("}"))
    status = F.when(F.col("o_orderstatus") == "F",
                    F.concat(F.lit('[{"sioDes":"Suplente"},{"sioDes":'), jstr(F.col("o_orderstatus")), F.lit("}]"))) \
              .otherwise(_obj(("sioDes", jstr(F.col("o_orderstatus")))))
    dep = _obj(("depId", jstr(F.col("o_orderkey"))),
               ("depNomeParlamentar", jstr(F.concat(F.lit("Cust#"), F.col("o_custkey").cast("string")))),
               ("depCPDes", jstr(F.lit("Lisboa"))),
               ("depGP", _obj(("pt_ar_wsgode_objectos_DadosSituacaoGP", _obj(("gpSigla", jstr(F.col("o_orderpriority"))))))),
               ("depSituacao", _obj(("pt_ar_wsgode_objectos_DadosSituacaoDeputado", status))))
    rec_json = _obj(("deputado", dep),
                    ("AtividadeDeputadoList", _obj(("pt_gov_ar_wsar_objectos_ActividadeOut", F.col("amap")))))
    return per_order.select(amap.alias("amap"), *per_order.columns).select(rec_json.alias("record"))


def all_code_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(record) per order: a member whose lineitems are spread over all activity
    types by (order key + line number) mod 12, four of them inside the reporter
    container, beside every kind of entry that is to be skipped."""
    li = load(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity",
                                                "l_linestatus", "l_shipdate")
    pa = load(spark, sf_dir, "part").select("p_partkey", "p_name")
    value = {"id": F.col("l_partkey"), "st": F.col("l_linestatus"), "a": F.col("l_linenumber"), "b": F.col("l_suppkey"),
             "c": F.col("l_quantity").cast("long"), "d": F.lit("x"), "day": F.to_date("l_shipdate"),
             "time": F.concat(F.to_date("l_shipdate").cast("string"), F.lit(" 10:00:00")), "text": F.col("p_name")}
    # type key (and reporter sub-key), then the fields of its entries
    kinds = [
        ("actP", dict(actId="id", actTpdesc="st", actNr="a", actSelLg="b", actDtent="day", actAs="text")),
        ("audicoes", dict(actId="id", actTpdesc="st", actNr="a", accDtaud="day", nomeEntidadeExterna="text")),
        ("audiencias", dict(actId="id", actTpdesc="st", actNr="a", actLg="b", accDtaud="day", actAs="text")),
        ("deslocacoes", dict(actId="id", actTp="st", cmsAb="a", actLg="b", actDtdes1="day", actAs="text")),
        ("eventos", dict(actId="id", tevTp="st", cmsAb="a", actLg="b", actDtent="day", actAs="text")),
        ("intev", dict(intId="id", tinDs="st", pubTp="a", pubNr="b", pubLg="c", pubSl="d", pubDtreu="day", intSu="text")),
        ("ini", dict(iniId="id", iniTpdesc="st", iniNr="a", iniTp="b", iniSelLg="c", iniSelNr="d", iniTi="text")),
        ("req", dict(reqId="id", reqPerTp="st", reqNr="a", reqLg="b", reqSl="c", reqDt="time", reqAs="text")),
        ("rel.relatoresIniciativas", dict(iniId="id", iniTp="st", iniNr="a", iniSelLg="b", iniTi="text")),
        ("rel.relatoresPeticoes", dict(petId="id", petNr="a", petSelLgPk="b", petSelNrPk="c", petAspet="text")),
        ("rel.relatoresIniEuropeias", dict(ineId="id", leg="a", ineDataRelatorio="day", ineTitulo="text")),
        ("rel.relatoresContasPublicas", dict(actId="id", actAs="text")),
    ]
    kind = F.pmod(F.col("l_orderkey") + F.col("l_linenumber"), F.lit(12)).cast("int")
    item = F.coalesce(*[F.when(kind == i, F.to_json(F.struct(*[value[v].cast("string").alias(k) for k, v in f.items()])))
                        for i, (_, f) in enumerate(kinds)])
    per_order = (li.join(pa, li.l_partkey == pa.p_partkey).groupBy("l_orderkey")
                 .agg(F.collect_list(F.struct(kind.alias("kind"), item.alias("item"))).alias("items")))

    def entry(i: int, key: str) -> Column:
        mine = F.filter("items", lambda x: x["kind"] == i)["item"]
        return F.when(F.size(mine) > 0, F.concat(F.lit(f'"{key}":{{"pt_wrapper":'), obj_or_array(mine), F.lit("}")))

    plain = [entry(i, k) for i, (k, _) in enumerate(kinds) if not k.startswith("rel.")]
    rel = F.array_compact(F.array(*[entry(i, k[4:]) for i, (k, _) in enumerate(kinds) if k.startswith("rel.")]))
    skipped = [F.lit(f'"{k}":{{"pt_wrapper":{{"actId":"skip","x":"1"}}}}') for k in
               ("dadosLegisDeputado", "cms", "dlE", "dlP", "parlamentoJovens", "scgt", "gpa")]
    whole = F.array_compact(F.array(*plain, F.when(F.size(rel) > 0, F.concat(F.lit('"rel":{'), F.array_join(rel, ","), F.lit("}"))), *skipped))
    amap = F.concat(F.lit("{"), F.array_join(whole, ","), F.lit("}"))
    return per_order.select(_obj(("deputado", _obj(("depId", jstr(F.col("l_orderkey"))))),
                                 ("AtividadeDeputadoList", _obj(("pt_gov_ar_wsar_objectos_ActividadeOut", amap)))).alias("record"))


def wrapped_part_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(record) per part: the part object under one to six single-key wrappers."""
    p = load(spark, sf_dir, "part")
    wrapped = [_obj(("pt_wrapper", F.to_json(F.struct("p_partkey", "p_name", "p_brand"))))]
    for i in range(5):
        wrapped.append(_obj((f"outer{i}", wrapped[-1])))
    return p.select(F.element_at(F.array(*wrapped), F.col("p_partkey").cast("int") % 6 + 1).alias("record"))


def optional_key_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(p_partkey, record): 'actAs' present when p_size < 20, 'nomeEntidadeExterna'
    when 10 <= p_size < 40, neither from 40 on."""
    p = load(spark, sf_dir, "part")
    size = F.col("p_size")
    rec = F.to_json(F.struct(
        F.col("p_partkey").alias("actId"),
        F.when(size < 20, F.col("p_name")).alias("actAs"),
        F.when((size >= 10) & (size < 40), F.col("p_brand")).alias("nomeEntidadeExterna")))
    return p.select("p_partkey", rec.alias("record"))


def initiative_records(spark: SparkSession, sf_dir: str,
                       untitled_status: str | None = None) -> DataFrame:
    """(record) per order, shaped like an initiative record.

    Order fields give id parts and a title with padding, a literal backslash-n
    and a newline; its lineitems (in line order) give the authors, the
    parties (distinct return flags) and one event each: status O -> entry
    event; status F -> publication event ('Votação Deliberação' for flag A),
    with publication data unless the flag is N; one publication (with pages
    when quantity > 10) or two when quantity > 25. Orders whose status equals
    ``untitled_status`` are packed without a title (a record the parser must
    quarantine).
    """
    li = load(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity",
        "l_returnflag", "l_linestatus", "l_shipdate")
    o = load(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", "o_orderpriority")
    day = qstr(F.to_date("l_shipdate"))
    s = lambda c: qstr(F.col(c))
    pub1 = F.concat(
        F.lit('{"pubdt":'), day, F.lit(',"pubNr":'), s("l_linenumber"),
        F.lit(',"pubTipo":'), qstr(F.concat(F.lit("DAR II série "), F.col("l_returnflag"))),
        F.lit(',"pubLeg":"XV","pubSL":"1"'),
        F.when(F.col("l_quantity") > 10, F.concat(F.lit(',"pag":{"string":'), s("l_partkey"), F.lit("}")))
         .otherwise(F.lit("")), F.lit("}"))
    pub2 = F.concat(F.lit('{"pubdt":'), day, F.lit(',"pubNr":'), s("l_partkey"),
                    F.lit(',"pubTipo":"DAR I série","pubLeg":"XV","pubSL":"2"}'))
    pubs = F.when(F.col("l_quantity") > 25, F.concat(F.lit("["), pub1, F.lit(","), pub2, F.lit("]"))) \
            .otherwise(pub1)
    phase = F.when(F.col("l_linestatus") == "O", F.lit("Entrada")) \
             .when(F.col("l_returnflag") == "A", F.lit("Votação Deliberação")).otherwise(F.lit("Publicação"))
    event = F.concat(F.lit('{"fase":'), qstr(phase), F.lit(',"dataFase":'), day,
                     F.when((F.col("l_linestatus") == "F") & (F.col("l_returnflag") != "N"),
                            F.concat(F.lit(',"publicacaoFase":{"pt_gov_ar_objectos_PublicacoesOut":'),
                                     pubs, F.lit("}"))).otherwise(F.lit("")),
                     F.lit("}"))
    author = F.concat(F.lit('{"nome":'), qstr(F.concat(F.lit("S"), F.col("l_suppkey").cast("string"))),
                      F.lit("}"))
    per_order = (li.join(o, li.l_orderkey == o.o_orderkey)
                 .groupBy("o_orderkey", "o_orderstatus", "o_orderpriority")
                 .agg(F.array_sort(F.collect_list(F.struct(
                          "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_shipdate",
                          "l_returnflag", "l_linestatus", author.alias("author"), event.alias("event"))))
                      .alias("items"),
                      F.array_sort(F.collect_set("l_returnflag")).alias("flags")))
    # flags, authors and events need no escaping here; array_join and struct
    # field extraction keep the packing in generated code (no lambdas)
    gp = F.split(F.concat(F.lit('{"GP":"'), F.array_join("flags", '"}\u0001{"GP":"'), F.lit('"}')),
                 "\u0001")
    title = F.concat(F.lit("  "), F.col("o_orderpriority"), F.lit("\\nOrder"), F.lit("\n"),
                     F.lit("text  "))
    # the title member is optional: it is emitted right after iniSel's value
    # (as ',"iniTitulo":...') or left out
    title_field = F.concat(F.lit(',"iniTitulo":'), jstr(title))
    if untitled_status is not None:
        title_field = F.when(F.col("o_orderstatus") == untitled_status, F.lit("")).otherwise(title_field)
    rec = _obj(("iniNr", qstr(F.col("o_orderkey"))), ("iniTipo", qstr(F.col("o_orderstatus"))),
               ("iniLeg", F.lit('"XV"')), ("iniSel", F.concat(F.lit('"1"'), title_field)),
               ("iniLinkTexto", qstr(F.concat(F.lit("https://files.example.org/ini/"),
                                              F.col("o_orderkey").cast("string")))),
               ("iniAutorGruposParlamentares", _obj(("pt_gov_ar_objectos_AutoresGruposParlamentaresOut",
                                                     obj_or_array(gp)))),
               ("iniAutorDeputados", _obj(("pt_gov_ar_objectos_iniciativas_AutoresDeputadosOut",
                                           obj_or_array(F.col("items")["author"])))),
               ("iniEventos", _obj(("pt_gov_ar_objectos_iniciativas_EventosOut",
                                    obj_or_array(F.col("items")["event"])))))
    return per_order.select(rec.alias("record"))

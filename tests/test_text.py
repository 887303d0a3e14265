"""Scalar string functions against tables of inputs and expected outputs."""

from pyspark.sql import functions as F

from vigil.functions import text as T

def _run(spark, fn, values):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, s string")
    return [r[0] for r in df.orderBy("i").select(fn(F.col("s"))).collect()]


STRIP = [("", ""), ("  a ", "a"), ("\t\n a b \r\n", "a b"), ("\u00a0x\u2003", "x"), (None, None)]
DEQUOTE = [("", ""), ("x", "x"), ("'", "'"), ('""', ""), ("'abc'", "abc"), ('"abc"', "abc"), ("  ' a '  ", "a"),
           ("'abc\"", "'abc\""), ("a'b'", "a'b'"), ("''a''", "'a'"), ("/a/", "/a/"), (" \" 'x' \" ", "'x'"), (None, None)]
CLEAN = [("", ""), ("A", "a"), (" a/b ", "ab"), ("a   b", "a__b"), ("a    b", "a__b"), ("É_-.", "e_-."), ("Straße Øl", "strasse_ol"),
         ("\tÇa \n", "ca"), ("1.ª Sessão n.º 2 – Série\u00a0I", "1.a_sessao_n.o_2_-_serie_i"), ("“x” …", '"x"_...'),
         ("e\u0301 a\u0303", "e_a"), ("Ελλάδα", "ellada"), (None, None)]


def test_strip_dequote_clean_tables(spark):
    for fn, rows in ((T.strip, STRIP), (T.dequote, DEQUOTE), (T.clean_string, CLEAN)):
        assert _run(spark, fn, [r[0] for r in rows]) == [r[1] for r in rows]


def test_clean_string_examples(spark):
    vals = ["  Início  ", "Agenda Parlamentar", "XV  Legislatura", "a   b", "Reuniões / Visitas"]
    assert _run(spark, T.clean_string, vals) == ["inicio", "agenda_parlamentar", "xv_legislatura",
                                                 "a__b", "reunioes_visitas"]


def test_title_first_token_and_ids(spark):
    assert _run(spark, T.title_clean, ["  a\\nb\nc  "]) == ["a b c"]
    assert _run(spark, T.first_token, ["  2023-01-02 10:00:00", "", "   ", None]) == [
        "2023-01-02", None, None, None]
    df = spark.createDataFrame([("1", None, "X")], "a string, b string, c string")
    assert df.select(T.format_id("a", "b", "c")).first()[0] == "1/None/X"
    assert df.select(T.format_id("a", "b", "c", null_text=None)).first()[0] is None
    assert _run(spark, T.dar_category, ["DAR II série A", "DAR I série"]) == ["II-A", "I série"]


def test_file_name_between_markers(spark):
    url = "https://files.example.org/doc.txt?path=abc&fich=ReuniaoNacionalIX_json.txt&Inline=true"
    other = "https://files.example.org/doc.txt?path=abc&fich=Registo%c3%banico.json.txt&Inline=true"
    got = _run(spark, lambda c: T.normalize_file_name(T.extract_between(c, "fich=", "&Inline=true")),
               [url, other, "https://x/no-marker"])
    assert got == ["reuniaonacionalix.json", "registounico.json", None]


def test_html_and_entities(spark):
    html = ('<html><head><style>p{}</style><script>var t="</p>";</script></head>'
            '<body><!-- c --><p>A &amp; B</p>\n<p>x&nbsp;y &lt;z&gt; &amp;lt;</p></body></html>')
    got = _run(spark, lambda c: T.decode_entities(T.strip_html(c)), [html])[0]
    assert got == "A & B x\u00a0y <z> &lt;"


def test_md5_matches_hashlib(spark):
    import hashlib
    vals = ["", "abc", "Início ß"]
    assert _run(spark, T.md5_hex, vals) == [hashlib.md5(v.encode()).hexdigest() for v in vals]


def test_numeric_character_references_match_html_unescape(spark):
    import html
    vals = ["caf&#233; &#xE9;t&#XE9; &#128512;!", "no refs here", "&#65;&#66;&#x43;", "&amp;#233; stays",
            "broken &#; and &#x; refs", ""]
    got = _run(spark, T.decode_entities, vals)
    assert got[0] == html.unescape(vals[0]) and got[2] == "ABC" and got[1] == vals[1]
    assert got[3] == "&#233; stays" and got[4] == vals[4] and got[5] == ""
    assert _run(spark, T.decode_entities, ["&#1114112; &#55296;"]) == ["\ufffd \ufffd"]


def test_named_references_in_one_pass(spark):
    vals = ["&ccedil;&atilde;o &ordm;&ordf; &Eacute;", "&#38;lt; &amp;lt; &amp;#233;", "&unknown; &amp &", "&hearts;&nbsp;&euro;"]
    assert _run(spark, T.decode_entities, vals) == ["ção ºª É", "&lt; &lt; &#233;", "&unknown; &amp &", "♥\u00a0€"]


def test_transliteration_table_leaves_nothing_but_ascii(spark):
    table = T.ascii_table()
    assert len(table) > 1500 and all(v.isascii() for v in table.values())
    got = _run(spark, T.fold_to_ascii, list(table) + ["".join(table)])
    assert got[:-1] == list(table.values()) and got[-1] == "".join(table.values())
    assert _run(spark, T.fold_to_ascii, ["Щука и Ёж № 5", "Ψυχή", "½ + ¾ = 1¼ €", "中文 x", "", None]) == [
        "Shchuka i Iozh No 5", "Psukhe", "1/2 + 3/4 = 11/4 EUR", "中文 x", "", None]

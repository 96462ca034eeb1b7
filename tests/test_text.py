"""Hand-computed cases for text, URL and HTML functions."""

import pytest
from pyspark.sql import functions as F

from loomdex.functions import analysis, arrays, html, kwic, text, urls
from loomdex.functions.stemmer import stem_ru
from loomdex.operators import vectors

T = F.col("t")


def column(spark, values, build):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, t string")
    return [r.r for r in df.select("i", build(T).alias("r")).orderBy("i").collect()]


def test_running_sum(spark):
    rows = spark.createDataFrame([([],), ([5],), (list(range(1, 38)),)], "a array<int>")
    got = [r.r for r in rows.select(arrays.running_sum(F.col("a")).alias("r")).collect()]
    expected = [[], [5], [n * (n + 1) // 2 for n in range(1, 38)]]
    assert sorted(got) == sorted(expected)


def test_token_offsets_are_bytes(evaluate):
    spans = evaluate(analysis.token_spans(T), t="Привет, мир! it's a.b")
    assert [(s.pos, s.start, s.end, s.token) for s in spans] == [
        (1, 0, 12, "привет"), (2, 14, 20, "мир"), (3, 22, 26, "it's"), (4, 27, 30, "a.b"),
    ]
    assert evaluate(analysis.token_spans(T), t=" ,. ") == []


@pytest.mark.parametrize("given, expected", [
    ("3,14 1;2 12:30 5. 1,a", ["3,14", "1;2", "12", "30", "5", "1", "a"]),
    ("v1.2 a.b a.1 1.a a_b.c a_.b _", ["v1.2", "a.b", "a", "1", "1", "a", "a_b.c", "a_", "b", "_"]),
    ("中文字 二〇〇一 3个", ["中", "文", "字", "二", "〇〇", "一", "3", "个"]),
    ("カタカナー ひらが データ2", ["カタカナー", "ひ", "ら", "が", "データ", "2"]),
    ("한국어 ไทย กี่", ["한국어", "ไ", "ท", "ย", "กี่"]),
    ("сло\u00adво a\u200db \u00ad x", ["сло\u00adво", "a\u200db", "x"]),
    ("it's ’tis o’clock' l··l й", ["it's", "tis", "o’clock", "l", "l", "й"]),
    ("😀 — ，。", []),
])
def test_word_rules(evaluate, given, expected):
    assert evaluate(analysis.tokens(T), t=given) == expected
    spans = evaluate(analysis.token_spans(T), t=given)
    assert [given.encode()[s.start:s.end].decode().lower() for s in spans] == expected


def test_long_words_are_matched_without_recursion(evaluate):
    for unit in ("a.", "1,", "a1", "中", "a\u0301_"):
        assert sum(len(t) for t in evaluate(analysis.tokens(T), t=unit * 200_000)) >= 200_000


def test_stemmer(spark):
    # Pairs from the published vocabulary of the algorithm.
    pairs = {
        "в": "в", "вавиловка": "вавиловк", "вагнера": "вагнер", "вагон": "вагон", "вагоне": "вагон", "важная": "важн",
        "важнейшие": "важн", "важничал": "важнича", "важности": "важност", "важностию": "важност", "важную": "важн",
        "п": "п", "павел": "павел", "павильон": "павильон", "падаль": "падал", "падение": "паден", "падчерицей": "падчериц",
        "прочитавши": "прочита", "читающая": "чита", "смеется": "смеет", "ёлка": "елк", "running": "running",
    }
    assert dict(zip(pairs, column(spark, list(pairs), stem_ru))) == pairs


def test_strip_boilerplate(spark):
    cases = {
        "From Wikipedia, the free encyclopedia\nBody": "Body",
        "x From Wikipedia, free. Body": ". Body",
        "Jump to navigation": "",
        "я" * 49 + "a" + "From Wikipedia\nkept": "kept",  # 99 bytes before
        "я" * 50 + "From Wikipedia\nkept": "я" * 50 + "From Wikipedia\nkept",  # 100 bytes before
        "  plain  ": "plain",
        "Перейти к навигации Перейти к поиску\nтекст": "текст",
    }
    assert column(spark, list(cases), text.strip_boilerplate) == list(cases.values())


def test_wiki_scrub(spark):
    cases = {
        "a[ПРАВИТЬ | КОД]b": "a b", "a[12]b": "a b", "a[ скрыть ]b": "a b",
        "эта статья о чём-то. да": "  да", "Запрос «x» перенаправляется сюда; ещё. да": "  да",
    }
    assert column(spark, list(cases), text.wiki_scrub) == list(cases.values())


def test_spaces_marks_escape(evaluate):
    assert evaluate(text.normalize_ws(T), t="  a \t\n b c ") == "a b c"
    assert evaluate(text.token_join(T), t=" a \x0bb\n") == "a b"
    assert evaluate(text.token_join(F.lit(None).cast("string"))) == "PDF read error"
    assert evaluate(text.strip_combining(T), t="éй") == "eй"
    assert evaluate(text.html_escape(T), t="&<>\"'") == "&amp;&lt;&gt;&quot;&#39;"
    assert evaluate(text.truncate(T, 3), t="a<bcd") == "a&lt;b..."
    assert evaluate(text.fold_case(T), t="İΣ") == "iσ"


@pytest.mark.parametrize("n,keep", [(199, False), (200, True)])
def test_minimum_size_is_bytes(evaluate, n, keep):
    assert evaluate(text.long_enough(T), t="a" * n) is keep
    assert evaluate(text.long_enough(T), t="я" * (n // 2) + "a" * (n % 2)) is keep


def test_urls(spark):
    cases = {
        "http://a.b/c": True, "HTTPS://a.b": True, "ftp://a.b": False, " http://a.b": False, "": False, "http://a:x/": False,
        "http://a.b/%zz": False, "http://a.b/?q=%zz": True, "http://a.b/\n": False,
    }
    assert column(spark, list(cases), urls.is_valid) == list(cases.values())
    media = {"http://a/b.PDF": True, "http://a/b.jpg?x": True, "http://a/b.jpgx": False, "http://a/b.js#x": False}
    assert column(spark, list(media), urls.is_media) == list(media.values())
    service = {
        "http://a/?x=1&action=edit": True, "http://a/%D1%88%D0%BF%D0%B0%D1%80%D0%B3%D0%B0%D0%BB%D0%BA%D0%B0": True,
        "http://a/LICENSE": False, "http://a/license%zz": True,
    }
    assert column(spark, list(service), urls.is_service) == list(service.values())
    ips = {
        "8.8.8.8": True, "10.1.1.1": False, "172.31.0.1": False, "172.32.0.1": True, "192.168.0.1": False, "127.0.0.1": False,
        "169.254.1.1": False, "0.1.2.3": False, "224.0.0.1": False, "100.64.0.1": True, "::1": False, "::": False,
        "fe80::1": False, "fd00::1": False, "2001:4860::8888": True, "::ffff:10.0.0.1": False, "nonsense": False,
        "300.1.1.1": False, "999.0.0.1": False, "abc:": False, "::ffff:7f00:1": False, "0:0:0:0:0:ffff:10.0.0.1": False, "fc::1": True,
        "": False, "1.2.3": False, "01.2.3.4": False, "::ffff:808:808": True, "1::2::3": False, "FE80::A": False, "::1.2.3.4": True, "1:2:3:4:5:6:7:8": True,
    }
    assert column(spark, list(ips), urls.is_public_ip) == list(ips.values())
    normal = {" HTTP://A.b/c#x ": "http://A.b/c", "http://a/?q#": "http://a/?q"}
    assert column(spark, list(normal), urls.normalize) == list(normal.values())


def test_allowed_hosts(evaluate):
    entries = F.array(F.lit(" Example.ORG "), F.lit(""))
    for name, ok in {"example.org": True, "a.example.org": True, "badexample.org": False}.items():
        assert evaluate(urls.host_allowed(F.lit(name), entries)) is ok
    assert evaluate(urls.host_allowed(F.lit("x"), F.expr("cast(array() as array<string>)"))) is True


def test_resolve(spark):
    base = F.lit("http://a.b:8/c/d?x=1#f")
    cases = {
        "#top": "", "e": "http://a.b:8/c/e", "./e": "http://a.b:8/c/e", "../e/./g/": "http://a.b:8/e/g/", "/e?q=..#z": "http://a.b:8/e?q=..",
        "//h/e": "http://h/e", "?y": "http://a.b:8/c/d?y", "https://h/x/../y": "https://h/y", "": "http://a.b:8/c/d?x=1",
        "../../../e": "http://a.b:8/e", "mailto:x": "mailto:x", "..": "http://a.b:8/",
    }
    assert column(spark, list(cases), lambda t: urls.resolve(base, t)) == list(cases.values())


def test_nested_elements_are_removed(evaluate):
    page = (
        "<body><nav>a<nav>b</nav>c</nav><div class='x sidebar'>d<div>e<div>f</div></div>g</div><p>keep</p>"
        "<table class=infobox><tr><td><table><tr><td>h</td></tr></table></td></tr></table><div class='infobox'>i</div>"
        "<span class=\"reference\">[1]</span><header>j</body>"
    )
    assert evaluate(html.strip_unwanted(T), t=page) == "<body><p>keep</p><div class='infobox'>i</div>"


def test_paragraphs_and_body(evaluate):
    long = "x" * 100
    page = f"<body><h1>T</h1><p><b>{long}<br><p title=\"a>b\"> two &amp;lt; &#1078;&#x436; </div>tail<script>'<p>no</p>'</script></body>"
    assert evaluate(html.html_to_text(T), t=page) == f"{long} two &lt; жж"
    short = "<html><head><title>no</title></head><body><h1>T</h1><p>short</p> tail</body></html>"
    assert evaluate(html.html_to_text(T), t=short) == "Tshort tail"
    assert evaluate(html.title(T), t="<title>\n A &amp; B </title>") == "A & B"
    assert evaluate(html.hrefs(T), t="<!--<a href=x>--><a class=b href='/y?a&amp;b'>z</a><a name=n>") == ["/y?a&b"]


def test_light_stem_and_words(spark, evaluate):
    cases = {"домами": "дом", "дама": "дам", "дом": "дом", "ами": "ами", "читать": "чит", "белого": "бел", "РЕКЕ": "рек"}
    assert column(spark, list(cases), kwic.light_stem) == list(cases.values())
    assert evaluate(kwic.query_words(T), t="Как найти café (дома)?") == ["найти", "caf", "дома"]


def test_excerpt(evaluate):
    body = "слово " * 60 + "цель найдена " + "слово " * 60
    words = F.array(F.lit("цели"))
    out = evaluate(kwic.excerpt(T, words), t=body)
    assert out.startswith("...слово") and out.endswith("слово...") and "цель найдена" in out
    assert evaluate(kwic.excerpt(T, F.array(F.lit("нету"))), t="б" * 201) == "б" * 200 + "..."
    assert evaluate(kwic.highlight(T, words), t="<цель>") == "&lt;<strong>цель</strong>&gt;"


def test_words_are_found_by_stem_at_word_starts(spark, evaluate):
    body = "ab1 Ёлка\u0001поДОМ x-ДОМУ дом 7дома İя"
    given = ["домами", "дома", "ab1ами", "елками", "лкaми", "ab1", "поды", "нету"]
    found = evaluate(kwic.find_each(T, F.array(*map(F.lit, given))), t=body)
    assert [(f.at, f.matched) for f in found] == [
        (17, "ДОМУ"), (27, "дома"), (-1, ""), (-1, ""), (-1, ""), (0, "ab1"), (9, "поДОМ"), (-1, ""),
    ]
    assert [(f.at, f.matched) for f in evaluate(kwic.find_each(T, F.array(F.lit("ёлками"), F.lit("i"))), t=body)] == [(4, "Ёлка"), (32, "i")]
    none = spark.createDataFrame([(None,)], "t string").select(kwic.find_each(T, F.array(F.lit("дом"))).alias("r")).first().r
    assert [(f.at, f.matched) for f in none] == [(-1, "")]


def test_letters_of_words_are_those_of_the_pattern(spark):
    rows = spark.range(0x110000).filter("id not between 55296 and 57343 and id > 0")
    utf8 = F.decode(F.unhex(F.lpad(F.hex("id"), 8, "0")), "UTF-32")
    found = {r.c for r in rows.select(utf8.alias("c")).filter(F.col("c").rlike("(?iu)[а-яёa-z]")).collect()}
    assert found == kwic.LETTERS


def test_query_words_are_found_in_arrow_batches(spark):
    """No column expression walks through the words of a text for every query word."""
    plan = spark.createDataFrame([("a",)], "t string").select(kwic.find_each(T, kwic.query_words(T)), kwic.excerpt(T, F.array(T)))
    assert str(plan._jdf.queryExecution().executedPlan()).count("ArrowEvalPython") >= 1


def test_token_rows_and_index_terms_are_those_of_the_column_forms(spark):
    given = ["Привет, МИР! it's a.b", None, "", " ,. ", "İΣ\u0001ёлка и 3,14 中文 データ2", "важнейшие\u0301 x" * 300]
    docs = spark.createDataFrame([(i, v) for i, v in enumerate(given)], "i bigint, t string")
    spans = docs.select("i", F.explode(analysis.token_spans(T)).alias("s")).select("i", "s.*")
    got = vectors.token_rows(docs, T, "i")
    assert got.dtypes == [("i", "bigint"), ("pos", "bigint"), ("start", "bigint"), ("end", "bigint"), ("token", "string")]
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, spans.collect()))
    terms = docs.select("i", F.array_join(analysis.analyze(T), " ").alias("terms"))
    assert sorted(map(tuple, vectors.index_terms(docs, T, "i").collect())) == sorted(map(tuple, terms.collect()))

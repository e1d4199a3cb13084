"""Readers, pages and sinks on small files."""

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.sources import pages, readers, sinks

PAIR = T.StructType([T.StructField("이름", T.StringType()), T.StructField("n", T.IntegerType())])


@pytest.mark.parametrize("encoding", ["euc-kr", "utf-8", "utf-8-sig"])
def test_csv_encodings(spark, tmp_path, encoding):
    (tmp_path / "a.csv").write_bytes("이름,n\n서울,1\n부산,x\n".encode(encoding))
    rows = readers.read_csv(spark, str(tmp_path), PAIR, "EUC-KR" if encoding == "euc-kr" else "UTF-8").collect()
    assert [tuple(r) for r in rows] == [("서울", 1), ("부산", None)]


def test_json_arrays(spark, tmp_path):
    (tmp_path / "a.json").write_text('[{"이름": "가", "n": 1},\n {"n": 2}]', encoding="utf-8")
    (tmp_path / "b.json").write_text("[]", encoding="utf-8")
    assert sorted((r["이름"] or "", r.n) for r in readers.read_json_records(spark, str(tmp_path), PAIR).collect()) == [("", 2), ("가", 1)]


def test_xml_items(spark, tmp_path):
    (tmp_path / "a.xml").write_text("<r><items><item><name>가</name><cnt>3</cnt></item><item><name/><cnt>x</cnt></item><item><cnt></cnt></item></items></r>", encoding="utf-8")
    schema = T.StructType([T.StructField("name", T.StringType()), T.StructField("cnt", T.IntegerType())])
    rows = [tuple(r) for r in readers.read_xml_items(spark, str(tmp_path), schema).collect()]
    assert rows[0] == ("가", 3) and [r[1] for r in rows[1:]] == [None, None]


def test_envelope_paths(spark):
    schema = "S struct<row: array<struct<a: string>>>"
    df = spark.createDataFrame([(1, '{"S":{"row":[{"a":"x"},{"a":"y"}]}}'), (2, '{"S":{"row":[]}}'), (3, "{}"), (4, "broken")], "i int, p string")
    assert sorted(map(tuple, readers.envelope_rows(df, "p", schema, "S.row", "i").collect())) == [(1, "x"), (1, "y")]


def test_trend_groups(spark):
    point = "array<struct<title: string, data: array<struct<period: string, ratio: double>>>>"
    df = spark.createDataFrame([([("g", [("2024-01", 1.0), ("2024-02", 2.0)]), ("h", [])],)], f"results {point}")
    assert sorted(map(tuple, readers.flatten_trend(df).collect())) == [("g", "2024-01", 1.0), ("g", "2024-02", 2.0)]


def test_schema_enforcement(spark):
    df = spark.createDataFrame([("1", "x"), ("b", "y")], "a string, c string")
    want = T.StructType([T.StructField("c", T.StringType()), T.StructField("a", T.IntegerType())])
    assert [tuple(r) for r in readers.enforce_schema(df, want).collect()] == [("x", 1), ("y", None)]
    with pytest.raises(ValueError):
        readers.enforce_schema(df, T.StructType([T.StructField("z", T.StringType())]))
    with pytest.raises(Exception):
        readers.enforce_schema(df, want, strict=True).collect()
    with pytest.raises(Exception, match="null in a"):
        readers.enforce_schema(df, T.StructType([T.StructField("a", T.IntegerType(), False)])).collect()


PAGE = ('<html><head><title> A &amp; B </title><style>p{}</style><script>var t="</p>";</script></head><body><nav><ul class="country_list">'
        '<li><a href="/x">가나</a><img alt="여행금지"><img src="i" alt=" 여행유의 "></li><li><a href="/y">다라</a></li></ul></nav>'
        '<div class="info">no</div><div class="cont">one <div>two</div> <b>three</b>&copy</div><table><tr><td>t</td></tr></table><sup>1</sup></body></html>')


def test_page_fields(spark):
    df = spark.createDataFrame([(1, PAGE), (2, "<p>x</p>"), (3, None)], "i int, h string")
    rows = df.select("i", pages.tag_text("h", "title", "none").alias("t"), pages.links("h").alias("l")).orderBy("i").collect()
    assert (rows[0].t, rows[0].l) == ("A & B", ["/x", "/y"]) and rows[1].t == "none"
    body = {r.i: r.body for r in pages.element_text(df, "i", "h", "div", {"class": "cont"}, "no body").collect()}
    assert body == {1: "one two three©", 2: "no body", 3: "no body"}
    text = df.filter("i = 1").select(pages.readable_text("h").alias("t"), pages.readable_text("h", 5).alias("s")).first()
    assert text.t == "A & B 가나 다라 no one two three ©" and text.s == "A & B"
    items = [(r.position, r.name, r.tokens) for r in pages.list_items(df, "h", "i").orderBy("position").collect()]
    assert items == [(1, "가나", ["여행금지", "여행유의"]), (2, "다라", [])]


def test_replace_only_touched_partitions(spark, tmp_path):
    path = str(tmp_path / "t")
    sinks.append(spark.createDataFrame([(1, "a"), (2, "b")], "v int, p string"), path, ["p"])
    sinks.replace(spark.createDataFrame([(9, "a")], "v int, p string"), path, ["p"], only_touched=True)
    assert sorted(tuple(r) for r in spark.read.parquet(path).collect()) == [(2, "b"), (9, "a")]
    sinks.replace(spark.createDataFrame([(5, "c")], "v int, p string"), path, ["p"])
    assert [tuple(r) for r in spark.read.parquet(path).collect()] == [(5, "c")]


def test_json_forms(spark):
    df = spark.sql("SELECT 1 AS a, timestamp_ntz'2024-01-02 03:04:05' AS t, CAST(NULL AS STRING) AS s, array(1, 2) AS n")
    assert df.select(sinks.json_records(df).alias("j")).first().j == '{"a":1,"t":"2024-01-02T03:04:05","s":null,"n":[1,2]}'
    assert sinks.nested_to_json(df.select("a", "n")).first().n == "[1,2]"


def test_bulk_load_and_sensitive_columns(spark, tmp_path):
    source, target = str(tmp_path / "s"), str(tmp_path / "t")
    df = spark.createDataFrame([(1, "x", "id")], "a int, b string, Ssn string")
    df.write.json(source)
    for truncate, rows in ((False, 1), (False, 2), (True, 1)):
        sinks.bulk_load(spark, source, target, ["a", "b"], "json", truncate)
        assert spark.read.parquet(target).count() == rows
    assert sinks.drop_sensitive(df, ["SSN"]).columns == ["a", "b"]
    with pytest.raises(ValueError):
        sinks.drop_sensitive(df, ["phone"])


def test_fields_by_selector(spark):
    page = """<html lang=de><body><div class="x cont" id='main'><p>one <b>two</b><br>  three<script>no</script></p>
      <div><time datetime="2024-05-06">6 May &amp; on</time></div></div><p class=cont>outside</p>
      <ul id=u><li><a href="/a?x=1&amp;y=2" title="">A</a><li><a>none</a><li><a href='/b'>B</ul><img alt="pic" src=i><custom/>tail</body>"""
    rows = [(1, page), (2, None), (3, ""), (4, "<p>no date</p></div><time>loose"), (5, "<div id=main><time>t"), (6, "<p>" + "word " * 300_000 + "</p>")]
    fields = {
        "body": ("div.cont", None, "no body", None), "date": ("#main time", None, "no date", None), "stamp": ("time[datetime]", "datetime", "none", None),
        "links": ("ul#u a", "href", "none", "|"), "texts": ("li a", None, "none", "|"), "lang": ("html", "lang", "?", None),
        "empty": ('a[title=""]', None, "none", None), "both": (".x.cont b", None, "none", None), "picture": ("img[src='i']", "alt", "none", None),
        "deep": ("html body div div time", None, "none", None), "any": ("#main *", None, "none", " / "), "size": ("p", None, "none", None)}
    found = {r["i"]: r for r in pages.fields_by_selector(spark.createDataFrame(rows, "i int, h string"), "i", "h", fields).collect()}
    assert tuple(found[1]) == (1, "one two three 6 May & on", "6 May & on", "2024-05-06", "/a?x=1&y=2|/b", "A|none|B", "de", "A", "two", "pic",
                               "6 May & on", "one two three / two /  / no / 6 May & on / 6 May & on".replace(" / no /", " /  /"), "one two three")
    for i in (2, 3):
        assert tuple(found[i])[1:] == ("no body", "no date", "none", "none", "none", "?", "none", "none", "none", "none", "none", "none")
    assert (found[4]["date"], found[4]["size"], found[5]["date"], len(found[6]["size"])) == ("no date", "no date", "t", 5 * 300_000 - 1)
    for wrong in ("", "a b[", "a>b", ".x div.", "p.x:y"):
        with pytest.raises(ValueError):
            pages.fields_by_selector(spark.createDataFrame(rows, "i int, h string"), "i", "h", {"f": (wrong, None, "", None)})

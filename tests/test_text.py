"""Text, HTML and chunking on literals and by invariants."""

import pytest
from hypothesis import given, settings, strategies as st
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from millrace.functions import formats, html as H, text as T
from millrace.operators import chunks as C
from millrace.operators.retrieval import NO_CONTEXT, apply_rankings, source_card, stuffed_context
from millrace.streaming import tokens


def one(spark, value, build, kind="string"):
    return spark.createDataFrame([(value,)], f"x {kind}").select(build(F.col("x")).alias("y")).first().y


@pytest.mark.parametrize("site", ["https://s.com", "https://s.com/"])
def test_links(spark, site):
    page = ('<a href="https://a/b">1</a><a class="x" href=\'/x\'>2</a><a href="x.html">3</a><a href="http://a">4</a>'
            '<a href="#top">5</a><a name="none">6</a><a href="mailto:m@s">7</a><a href="/x">8</a><area href="/no">')
    assert one(spark, page, lambda x: H.links(x, F.lit(site))) == [
        "https://a/b", "https://s.com/x", "https://s.com/x.html", "https://s.com/http://a", "https://s.com/#top",
        "https://s.com/mailto:m@s", "https://s.com/x"]


def test_links_as_a_parser_sees_them(spark):
    page = ('<A HREF="/upper">1</A><a href=/bare>2</a><a data-href="/no" id=x>3</a><a data-href="/no" href="/yes">4</a>'
            '<a title="a > b" href="/q?a=1&amp;b=2">5</a><a href = \'/sp ace\'>6</a><abbr href="/no">7</abbr><a\n href="/line&#8217;">8</a>'
            '<a title="href=/no">9</a><a href>10</a>')
    assert one(spark, page, lambda x: H.links(x, F.lit("https://s.com"))) == [
        "https://s.com" + p for p in ("/upper", "/bare", "/yes", "/q?a=1&b=2", "/sp ace", "/line\u2019")]


def test_entities(spark):
    for text, want in (("a&#8217;b&mdash;c", "a\u2019b\u2014c"), ("&#x1F600;&amp;#65;", "\U0001F600&#65;"), ("&#0;&#xD800;&#1114112;", None),
                       ("&unknown; & &;", None), ("&apos;&lt;&amp;lt;", "'<&lt;"), ("no", None)):
        assert one(spark, text, H.unescaped) == (text if want is None else want)
    assert one(spark, "<DIV>a</DIV><Li>b</lI>", lambda x: H.tag_texts(x, ["div", "li"])) == ["a", "b"]


@pytest.mark.parametrize("value,want", [(-0.5, "-0.50"), (float("nan"), "nan"), (float("inf"), "inf"), (float("-inf"), "-inf"),
                                        (2.675, "2.67"), (-1234.5, "-1234.50")])
def test_fixed_takes_any_number(spark, value, want):
    assert one(spark, value, lambda x: formats.fixed(x, 2), "double") == want


def test_tags_in_page_order(spark):
    page = "<div>a &amp;lt; <b>b</b></div><p>no</p><span class='s'>c\n c</span><div>d</div><divider>e</divider>"
    assert one(spark, page, lambda x: H.tag_texts(x, ["span", "div"])) == ["a &lt; b", "c c", "d"]


def test_render_does_not_fill_twice(spark):
    df = spark.createDataFrame([("{b}", "2")], "a string, b string")
    filled = T.render("{a}-{{ b }}-{{a}}", {"a": F.col("a"), "b": F.col("b")})
    assert df.select(filled).first()[0] == "{b}-2-{b}"
    with pytest.raises(KeyError):
        T.render("{missing}", {})


@pytest.mark.parametrize("line,total,first", [
    ("[Compute Purchases: $61,500, $12,250], [Storage Purchases: $7,000], [Inquiries: 2 in the past month]", 80_750, True),
    ("[Compute Purchases: $1,100, $300], [Storage Purchases: $250], [Inquiries: 9 in the past month]", 1_650, False),
    ("[Compute Purchases: $44,000], [Storage Purchases: $18,000, $31,000], [Inquiries: 7 in the past month]", 93_000, True),
    ("[Compute Purchases: $75], [Storage Purchases: $20], [Inquiries: 0 in the past month]", 95, False),
])
def test_priority(spark, line, total, first):
    assert one(spark, line, T.purchases_total) == total
    assert one(spark, line, T.priority) is first


def test_sections(spark):
    assert one(spark, "x <products>\n a\nb </products> y", lambda x: T.section(x, "products")) == "a\nb"
    for empty in ("none", "<products> </products>"):
        assert one(spark, empty, lambda x: T.section(x, "products")) == T.NOTHING_FOUND


@pytest.mark.parametrize("said,guard,want", [
    ("on-topic", "g", True), (" On-Topic.\n", "g", True), ("off-topic", "g", False), ("", "g", False), (None, "g", False),
    ("off-topic", None, True), ("off-topic", "", True),
])
def test_guard(spark, said, guard, want):
    df = spark.createDataFrame([(said, guard)], "s string, g string")
    assert df.select(T.on_topic(F.col("s"), F.col("g"))).first()[0] is want


def test_critique(spark):
    text = "{bugs: 4, transformation: 8, compliance: 10, type: 7, encoding: 9, aesthetics: 1}"
    df = spark.createDataFrame([(text, True), (text.replace("4", "6"), True), (text.replace("10", "11"), False), ("none", False)], "t string, b boolean")
    got = [r[0] for r in df.select(T.critique_valid(T.critique_scores(F.col("t")), F.col("b"))).collect()]
    assert got == [True, False, False, False]


def test_code_blocks_and_multimodal(spark):
    text = "see\n```python\nprint(1)\n```\nor\n```\nls\n```\n"
    assert [tuple(b) for b in one(spark, text, T.code_blocks)] == [("python", "print(1)\n"), ("", "ls\n")]
    parts = one(spark, ["u1", "u2"], lambda x: T.multimodal(F.lit("t"), x), "array<string>")
    assert [(p.type, p.text, p.image_url) for p in parts] == [("text", "t", None), ("image_url", None, "u1"), ("image_url", None, "u2")]


@pytest.mark.parametrize("value", [0.0, 0.5, 1.5, 2.5, 12.345, 19.85, 0.25, 0.35, 99.95, 0.05, 0.0004, 1234567.875, 1e-9])
@pytest.mark.parametrize("decimals", [0, 1, 3])
def test_fixed_like_printf(spark, value, decimals):
    assert one(spark, value, lambda x: formats.fixed(x, decimals), "double") == f"{value:.{decimals}f}"


@pytest.mark.parametrize("value", [-0.0004, 0.1985, -0.051, 0.32, 1.0])
def test_percent(spark, value):
    assert one(spark, value, formats.percent, "double") == f"{value:.1%}"
    assert one(spark, value, formats.signed_percent, "double") == f"{value:+.1%}"


@settings(max_examples=150, deadline=None)
@given(st.text(alphabet=st.sampled_from("ab \n"), max_size=400), st.integers(5, 60), st.integers(0, 5))
def test_recursive_chunks_cover_the_text(text, size, overlap):
    chunks = C.split_text(text, size, overlap)
    assert all(0 < len(c) <= size and c == c.strip() for c in chunks)
    assert all(c in text for c in chunks)
    solid = lambda t: "".join(t.split())
    whole = solid(text)
    if overlap == 0:
        assert solid("".join(chunks)) == whole
    else:
        # every chunk goes on where the last one ended, or up to ``overlap`` characters before
        ends = {0}
        for c in map(solid, chunks):
            ends = {at - back + len(c) for at in ends for back in range(overlap + 1)
                    if at >= back and whole.startswith(c, at - back)}
        assert len(whole) in ends


def test_recursive_chunks_prefer_coarse_breaks():
    text = "one two\n\nthree four\nfive six seven"
    assert C.split_text(text, 20, 0) == ["one two", "three four", "five six seven"]
    assert C.split_text("abcdefghij", 4, 1) == ["abcd", "defg", "ghij"]
    assert C.split_text("aa bb cc dd", 6, 3) == ["aa bb", "bb cc", "cc dd"]
    with pytest.raises(ValueError):
        C.split_text("a", 3, 4)


def test_chunk_tables(spark):
    docs = spark.createDataFrame([(1, "x" * 1600, "s"), (2, "", "s"), (3, None, "s")], "doc_id bigint, text string, source string")
    fixed = C.fixed_chunks(docs.filter("doc_id = 1"), "doc_id", "text", 800, 740, keep=["source"]).collect()
    assert [(r.chunk, len(r.text), r.source) for r in fixed] == [(0, 800, "s"), (1, 800, "s"), (2, 120, "s")]
    cut = C.recursive_chunks(docs, "doc_id", "text", 800, 60, keep=["source"]).collect()
    assert {r.doc_id for r in cut} == {1} and [r.chunk for r in cut] == list(range(len(cut)))


def test_passages(spark):
    texts = spark.createDataFrame([(1, "zz the cat sat on the mat today yy"), (2, "a cat sat on the mat today"), (3, "x1 one two threes")], "id bigint, text string")
    passages = spark.createDataFrame([(10, "e cat sat on the mat toda"), (11, "one two three"), (12, "the dog sat on the mat")], "id bigint, text string")
    got = {(r.id, r.passage_id) for r in C.passage_places(texts, passages).collect()}
    assert got == {(1, 10), (3, 11)}
    with pytest.raises(PySparkException, match="three words"):
        C.passage_places(texts, passages.limit(1).selectExpr("id", "'two words' as text")).collect()


def test_rankings_drop_bad_positions(spark):
    candidates = spark.createDataFrame([("q", i, 100 + i, "s") for i in range(3)], "query_id string, position bigint, doc_id bigint, source string")
    rankings = spark.createDataFrame(
        [("q", 0, 2, 1.5, 9.0), ("q", 1, None, 1.0, 1.0), ("q", 2, -1, 1.0, 1.0), ("q", 3, 3, 1.0, 1.0), ("q", 4, 0, None, 0.5)],
        "query_id string, seq int, index int, logit double, score double")
    got = [(r.doc_id, r.relevance_score) for r in apply_rankings(candidates, rankings).orderBy("seq").collect()]
    assert got == [(102, 1.5), (100, 0.5)]


def test_contexts_and_cards(spark):
    queries = spark.createDataFrame([("a",), ("b",)], "qid string")
    chunks = spark.createDataFrame([("a", 2, 7, "second"), ("a", 1, 9, "first")], "qid string, rank int, id int, text string")
    got = {r.qid: r.context for r in stuffed_context(queries, chunks).collect()}
    assert got == {"a": "first\n\n---\n\nsecond", "b": NO_CONTEXT}
    none = F.lit(None).cast("string")
    card = spark.range(1).select(source_card(F.lit(1), F.lit(" t \n"), none, none, none, F.lit(None).cast("double"))).first()[0]
    assert "**Source:** Unknown Source  \n**Author:** Unknown  \n**Page:** N/A\n" in card
    assert "Relevance" not in card and card.endswith("**Snippet:**  \nt...\n\n")
    scored = spark.range(1).select(source_card(F.lit(2), F.lit("t"), F.lit("s"), F.lit("a"), F.lit(3), F.lit(0.25))).first()[0]
    assert "**Relevance Score:** 0.25\n" in scored and "**Page:** 3\n" in scored


def test_stream_pieces(spark):
    messages = spark.createDataFrame([(1, "abcdefgh" * 9), (2, "")], "id bigint, text string")
    cut = tokens.pieces(messages, ["id"], "text", 5)
    back = {r.id: r.text for r in tokens.joined(cut.orderBy(F.rand(1)), ["id"]).collect()}
    assert back == {1: "abcdefgh" * 9, 2: ""}


def test_stream_of_pieces(spark, tmp_path):
    import json
    import os
    first = [{"id": 1, "seq": 1, "chunk": "lo", "at": "2024-01-01T00:00:01"}, {"id": 1, "seq": 0, "chunk": "hel", "at": "2024-01-01T00:00:00"},
             {"id": 2, "seq": 0, "chunk": "a", "at": "2024-01-01T00:00:02"}]
    second = [{"id": 2, "seq": 1, "chunk": "b", "at": "2024-01-01T00:00:20"}, {"id": 3, "seq": 0, "chunk": "late", "at": "2024-01-01T01:00:00"}]
    third = [{"id": 4, "seq": 0, "chunk": "x", "at": "2024-01-01T01:00:01"}]
    for i, rows in enumerate([first, second, third]):
        (tmp_path / f"{i}.json").write_text("\n".join(map(json.dumps, rows)))
        os.utime(tmp_path / f"{i}.json", (1_700_000_000 + i, 1_700_000_000 + i))  # files are taken oldest first
    stream = spark.readStream.schema("id bigint, seq int, chunk string, at timestamp").option("maxFilesPerTrigger", 1).json(str(tmp_path))
    run = (tokens.joined_stream(stream, ["id"], "at").writeStream.format("memory").queryName("pieces").outputMode("append")
           .option("checkpointLocation", str(tmp_path / "state")).trigger(availableNow=True).start())
    run.awaitTermination(120)
    assert {tuple(r) for r in spark.sql("select * from pieces").collect()} == {(1, "hello"), (2, "ab")}

"""Text, HTML, prompts and lexical search."""

from __future__ import annotations

from pyspark.sql import Window as W, functions as F

from millrace.functions import html as H, text as T
from millrace.operators import chunks as C, lexical, retrieval as R
from millrace.operators.sampling import words
from millrace.plans.registry import query
from millrace.operators.sizing import small_side, spread
from millrace.session import load
from millrace.sources.readers import data_uri
from millrace.sources.staging import stage
from millrace.streaming import tokens

# Text between tags, with the depth of open elements counted tag by tag; an element begins where the depth leaves zero.
@query("txt_extract_tags", """
with cut as (
  select page_id, unnest(string_split(html, '<')) as piece, unnest(range(len(string_split(html, '<')))) as n from pages),
tags as (
  select page_id, n, substr(piece, instr(piece, '>') + 1) as text,
         case when regexp_matches(piece, '^(div|li)[ >]') then 1 when regexp_matches(piece, '^/(div|li)>') then -1 else 0 end as step from cut),
deep as (select *, sum(step) over (partition by page_id order by n) as depth from tags),
begun as (
  select *, sum(case when step = 1 and depth = 1 then 1 else 0 end) over (partition by page_id order by n) as element from deep),
texts as (
  select page_id, element, trim(regexp_replace(""" + H.sql_unescaped("string_agg(text, ' ' order by n)") + """, '[ \\t\\n\\r]+', ' ', 'g')) as text
  from begun where depth > 0 group by 1, 2)
select page_id, coalesce(string_agg(texts.text, ' ' order by element), '') as text from pages left join texts using (page_id) group by 1""")
def txt_extract_tags(spark, d):
    return spread(load(spark, d, "pages").select("page_id", "html")).select("page_id", H.tags_text(F.col("html"), ["div", "li"]).alias("text"))


# The pages' anchors are all written <a ... href="...">, so cutting at these words finds them without a pattern.
_LINKS_SQL = """l as (
  select page_id, regexp_extract(url, '^(https?://[^/?#]+)', 1) as site,
    list_transform(list_filter(string_split(html, '<a ')[2:], lambda t: contains(split_part(t, '>', 1), 'href="')),
                   lambda t: """ + H.sql_unescaped("split_part(split_part(t, 'href=\"', 2), '\"', 1)") + """) as hrefs from pages),
x as (select page_id, site, unnest(hrefs) as h, unnest(range(1, len(hrefs) + 1)) as pos from l)
select page_id, pos, case when starts_with(h, 'https://') then h when starts_with(h, '/') then concat(site, h)
  else concat(site, '/', h) end as link from x"""


def _links(spark, d):
    pages = spread(load(spark, d, "pages").select("page_id", "url", "html"))
    return pages.select("page_id", H.links(F.col("html"), H.site_of(F.col("url"))).alias("links"))


def _listed(found):
    # A plain explode would have the optimizer filter by the list's size, and read each page twice for it.
    listed = found.select("page_id", F.posexplode_outer("links").alias("pos", "link")).filter("pos is not null")
    return listed.withColumn("pos", (F.col("pos") + 1).cast("bigint"))


@query("txt_links", f"with {_LINKS_SQL}")
def txt_links(spark, d):
    return _listed(_links(spark, d))


@query("lim_first_n", f"select * from (with {_LINKS_SQL}) where pos <= 8")
def lim_first_n(spark, d):
    # The links of a page are one array, so the first eight need neither sort nor shuffle.
    return _listed(_links(spark, d).withColumn("links", F.slice("links", 1, 8)))


@query("prj_truncate", """
select doc_id, substr(text, 1, 1000) as head,
       concat(trim(substr(text, 1, 500), concat(' ', chr(9), chr(10), chr(13))), '...') as snippet from documents""")
def prj_truncate(spark, d):
    text = F.col("text")
    return load(spark, d, "documents").select(
        "doc_id", T.truncated(text, 1000).alias("head"), T.snippet(text).alias("snippet")
    )


@query("txt_chunk_fixed", """
select doc_id, (start // 740)::bigint as chunk, substr(text, start + 1, 800) as text
from (select doc_id, text, unnest(range(0, greatest(length(text), 1), 740)) as start from documents)""")
def txt_chunk_fixed(spark, d):
    return C.fixed_chunks(load(spark, d, "documents").select("doc_id", "text"), "doc_id", "text")


@query("txt_chunk_recursive")
def txt_chunk_recursive(spark, d):
    docs = spread(load(spark, d, "documents").select("doc_id", "text", "source"))
    return C.recursive_chunks(docs, "doc_id", "text", 800, 60, keep=["source"])


_REPORT = [("1000/200", 1000, 800), ("800/60", 800, 740)]


@query("agg_chunk_report", "with all_chunks as (" + " union all ".join(
    f"""select '{name}' as strategy, substr(text, start + 1, {size}) as text
    from (select text, unnest(range(0, greatest(length(text), 1), {stride})) as start from documents)"""
    for name, size, stride in _REPORT) + """),
s as (select strategy, count(*) as chunks, avg(length(text)) as mean_chars, max(length(text))::bigint as max_chars
      from all_chunks group by 1),
f as (select strategy, count(distinct item_id) as found from all_chunks c join benchmark b on contains(c.text, b.text) group by 1)
select s.strategy, chunks, round(mean_chars, 4) as mean_chars, max_chars,
       round(coalesce(found, 0) / (select count(*) from benchmark), 6) as found_share
from s left join f on s.strategy = f.strategy""")
def agg_chunk_report(spark, d):
    docs = spread(load(spark, d, "documents").select("doc_id", "text"))
    passages = load(spark, d, "benchmark").select(F.col("item_id").alias("id"), "text")
    places = stage(C.passage_places(docs.withColumnRenamed("doc_id", "id"), passages), "places")
    total = passages.agg(F.count("*").alias("n")).scalar()
    report = None
    for name, size, stride in _REPORT:
        cut = C.fixed_chunks(docs, "doc_id", "text", size, stride)
        found = C.passages_in_chunks(docs, places, size, stride).agg(F.count("*").alias("n")).scalar()
        row = C.chunk_sizes(cut, name).withColumn("found_share", F.round(found / total, 6))
        report = row if report is None else report.unionByName(row)
    return report.withColumn("mean_chars", F.round("mean_chars", 4))


_TEMPLATE = "Use this text only.\n\nContext: {{context}}\nQuestion: {question}\nItem {id}:"


@query("txt_prompt_render", """
select item_id, concat('Use this text only.', chr(10), chr(10), 'Context: ', text, chr(10),
  'Question: What is said?', chr(10), 'Item ', item_id::varchar, ':') as prompt from benchmark""")
def txt_prompt_render(spark, d):
    filled = T.render(_TEMPLATE, {"context": F.col("text"), "question": F.lit("What is said?"), "id": F.col("item_id")})
    return load(spark, d, "benchmark").select("item_id", filled.alias("prompt"))


@query("txt_few_shot", """
with ex as (select doc_id, text, quality from documents join labels using (doc_id) order by doc_id limit 4),
b as (select string_agg(concat('Q: ', text, chr(10), 'Answer: ', case quality when 1 then 'True' else 'False' end),
             concat(chr(10), chr(10)) order by doc_id) as shots from ex)
select doc_id, md5(concat(shots, chr(10), chr(10), 'Q: ', text, chr(10), 'Answer: ')) as digest
from documents, b where doc_id not in (select doc_id from labels)""")
def txt_few_shot(spark, d):
    from millrace.operators.prompts import few_shot
    docs, labels = load(spark, d, "documents").select("doc_id", "text"), load(spark, d, "labels")
    solved = docs.join(labels.select("doc_id", (F.col("quality") == 1).alias("answer")), "doc_id")
    open_ones = docs.join(labels.select("doc_id"), "doc_id", "left_anti")
    return few_shot(solved, open_ones, "doc_id", 4).select("doc_id", F.md5("prompt").alias("digest"))


@query("txt_messages", """
select item_id, 0::bigint as pos, 'system' as role, 'Give the text below in two sentences' as content from benchmark
union all select item_id, 1, 'user', text from benchmark""")
def txt_messages(spark, d):
    system = F.lit("Give the text below in two sentences")
    rows = load(spark, d, "benchmark").select("item_id", F.posexplode(T.messages(system, F.col("text"))).alias("pos", "m"))
    return rows.select("item_id", F.col("pos").cast("bigint").alias("pos"), "m.role", "m.content")


@query("txt_instruct_format", "select item_id, concat('<s>[INST] ', text, ' [/INST]') as prompt from benchmark")
def txt_instruct_format(spark, d):
    return load(spark, d, "benchmark").select("item_id", T.instruct(F.col("text")).alias("prompt"))


_ACTIVITY = """concat('Customer Activity - [Compute Purchases: $', {a}, ', $', {b}, '], [Storage Purchases: $', {c},
  '], [Inquiries: ', cast(c_nationkey % 6 as {s}), ' in the past month]')"""
_AMOUNTS = ["c_custkey * 131 % 90000", "c_custkey * 17 % 50000", "c_custkey * 7 % 30000"]


@query("num_priority_rule", f"""
select c_custkey, ({_AMOUNTS[0]} + {_AMOUNTS[1]} + {_AMOUNTS[2]})::bigint as total, (c_nationkey % 6)::bigint as inquiries,
  ({_AMOUNTS[0]} + {_AMOUNTS[1]} + {_AMOUNTS[2]}) >= 50000 and c_nationkey % 6 >= 2 as priority from customer""")
def num_priority_rule(spark, d):
    a, b, c = (f"format_number({x}, 0)" for x in _AMOUNTS)
    line = load(spark, d, "customer").select("c_custkey", F.expr(_ACTIVITY.format(a=a, b=b, c=c, s="string")).alias("activity"))
    said = F.col("activity")
    return line.select(
        "c_custkey", T.purchases_total(said).alias("total"), T.inquiries(said).alias("inquiries"),
        T.priority(said).alias("priority"),
    )


@query("txt_section_extract", """
with r as (select doc_id, case lang when 'en' then concat('Found: <products>', chr(10), text, chr(10), '</products> end')
  when 'de' then '<products> </products>' else text end as reply from documents),
x as (select doc_id, trim(regexp_extract(reply, '(?s)<products>(.*?)</products>', 1), concat(' ', chr(9), chr(10), chr(13))) as inner_text from r)
select doc_id, case when inner_text = '' then 'No relevant information found!' else inner_text end as section from x""")
def txt_section_extract(spark, d):
    reply = F.expr("""case lang when 'en' then concat('Found: <products>', chr(10), text, chr(10), '</products> end')
                      when 'de' then '<products> </products>' else text end""")
    return load(spark, d, "documents").select("doc_id", T.section(reply, "products").alias("section"))


@query("txt_context_stuff", """
with r as (select source, text, doc_id, row_number() over (partition by source order by n_chars desc, doc_id) as rank
           from documents where lang = 'en'),
q as (select distinct source as qid from documents union all select distinct concat('none-', source) from documents),
c as (select source as qid, string_agg(text, concat(chr(10), chr(10), '---', chr(10), chr(10)) order by rank) as context
      from r where rank <= 4 group by 1)
select qid, coalesce(context, 'The provided documents do not contain this information.') as context from q left join c using (qid)""")
def txt_context_stuff(spark, d):
    docs = load(spark, d, "documents").select("doc_id", "text", "source", "lang", "n_chars")
    order = W.partitionBy("source").orderBy(F.col("n_chars").desc(), "doc_id")
    found = docs.filter("lang = 'en'").withColumn("rank", F.row_number().over(order)).filter("rank <= 4").select(
        F.col("source").alias("qid"), "rank", F.col("doc_id").alias("id"), "text"
    )
    names = docs.select(F.explode(F.array("source", F.concat(F.lit("none-"), "source"))).alias("qid")).distinct()
    return R.stuffed_context(names, found)


@query("txt_source_cards", """
select doc_id, concat('### Source Document ', doc_id, chr(10), chr(10), '**Source:** ',
  coalesce(case when lang <> 'de' then source end, 'Unknown Source'), '  ', chr(10), '**Author:** ',
  coalesce(case lang when 'en' then lang end, 'Unknown'), '  ', chr(10), '**Page:** ',
  coalesce(case when lang <> 'fr' then doc_id::varchar end, 'N/A'), chr(10),
  case when quality is null then '' else concat('**Relevance Score:** ', (quality / 4.0)::double::varchar, chr(10)) end,
  chr(10), chr(10), '**Snippet:**  ', chr(10),
  trim(substr(text, 1, 500), concat(' ', chr(9), chr(10), chr(13))), '...', chr(10), chr(10)) as card
from documents left join labels using (doc_id)""")
def txt_source_cards(spark, d):
    docs = load(spark, d, "documents").select("doc_id", "text", "source", "lang")
    rows = docs.join(load(spark, d, "labels").select("doc_id", "quality"), "doc_id", "left")
    lang = F.col("lang")
    card = R.source_card(
        F.col("doc_id"), F.col("text"), F.when(lang != "de", F.col("source")), F.when(lang == "en", lang),
        F.when(lang != "fr", F.col("doc_id")), F.col("quality") / 4.0,
    )
    return rows.select("doc_id", card.alias("card"))


_VERDICT = """case lang when 'en' then concat(chr(10), ' On-Topic. ') when 'fr' then 'off-topic'
  when 'de' then '' else concat('This is ON-TOPIC: ', text) end"""


@query("txt_guard_flag", f"""
with g as (select doc_id, {_VERDICT} as said, case when source = 'src1' then null else source end as guard from documents)
select doc_id, case when guard is null then true else contains(lower(trim(said)), 'on-topic') end as on_topic from g""")
def txt_guard_flag(spark, d):
    guard = F.when(F.col("source") != "src1", F.col("source"))
    return load(spark, d, "documents").select("doc_id", T.on_topic(F.expr(_VERDICT), guard).alias("on_topic"))


@query("txt_sentiment", """
with w as (select doc_id, unnest(regexp_extract_all(lower(text), '[^ \\t\\n\\r]+')) as word from documents),
l as (select doc_id, quality from labels join documents using (doc_id)),
t as (select count(*) filter (where quality = 1) as ng, count(*) filter (where quality = 0) as nb from l),
c as (select word, count(distinct doc_id) filter (where quality = 1) as g, count(distinct doc_id) filter (where quality = 0) as b
      from w join l using (doc_id) group by 1),
lexicon as (select word, sign(g * nb - b * ng)::bigint as weight from c, t where g + b >= 5 and g * nb <> b * ng),
s as (select doc_id, sum(weight)::bigint as score from w join lexicon using (word) group by 1)
select doc_id, coalesce(score, 0) as score,
       case when score > 0 then 'positive' when score < 0 then 'negative' else 'neutral' end as sentiment from documents left join s using (doc_id)""")
def txt_sentiment(spark, d):
    """By a lexicon that the labelled documents give: words more usual in good ones, and in bad ones."""
    docs = spread(load(spark, d, "documents").select("doc_id", "text"))
    labelled = docs.join(load(spark, d, "labels").select("doc_id", (F.col("quality") == 1).alias("good")), "doc_id")
    return lexical.sentiment(docs, stage(lexical.learnt_lexicon(labelled), "lexicon"))


_MESSAGE = """case when role = 'assistant' then concat(text, chr(10), '```python', chr(10), 'print(', cast(turn as {s}), ')',
  chr(10), '```', chr(10), 'and', chr(10), '```', chr(10), 'ls', chr(10), '```') else text end"""


@query("txt_code_blocks", f"""
with m as (select conv_id, turn, {_MESSAGE.format(s='varchar')} as text from conversations),
b as (select conv_id, turn, regexp_extract_all(text, '(?s)```([A-Za-z0-9_+-]*)\\n(.*?)```', 1) as l,
             regexp_extract_all(text, '(?s)```([A-Za-z0-9_+-]*)\\n(.*?)```', 2) as c from m)
select conv_id, turn, unnest(range(len(l))) as pos, unnest(l) as language, unnest(c) as code from b""")
def txt_code_blocks(spark, d):
    said = load(spark, d, "conversations").select("conv_id", "turn", F.expr(_MESSAGE.format(s="string")).alias("text"))
    rows = said.select("conv_id", "turn", F.posexplode(T.code_blocks(F.col("text"))).alias("pos", "b"))
    return rows.select("conv_id", "turn", F.col("pos").cast("bigint").alias("pos"), "b.language", "b.code")


_CRITIQUE = """concat('Scores: {bugs: ', cast(p_size % 10 + 1 as TEXT_), ', transformation: ', cast(p_size % 11 as TEXT_),
  ', compliance: ', cast(p_partkey % 9 + 1 as TEXT_), ', type: 7, encoding: ', cast(p_partkey % 8 + 2 as TEXT_),
  ', aesthetics: ', cast(p_size % 12 as TEXT_), '}')"""


@query("json_critique_scores", """
with s as (select p_partkey, p_size % 10 + 1 as bugs, p_size % 11 as transformation, (p_partkey % 9 + 1)::int as compliance,
  7 as type, (p_partkey % 8 + 2)::int as encoding, p_size % 12 as aesthetics, p_size % 2 = 0 as has_bug from part)
select p_partkey, bugs, transformation, compliance, type, encoding, aesthetics,
  (transformation between 1 and 10) and (aesthetics between 1 and 10) and (not has_bug or bugs < 5) as valid from s""")
def json_critique_scores(spark, d):
    said = load(spark, d, "part").select(
        "p_partkey", F.expr(_CRITIQUE.replace("TEXT_", "string")).alias("text"), (F.col("p_size") % 2 == 0).alias("has_bug")
    )
    scores = T.critique_scores(F.col("text"))
    return said.select(
        "p_partkey", *[c.alias(k) for k, c in scores.items()],
        T.critique_valid(scores, F.col("has_bug")).alias("valid"),
    )


@query("txt_search_lexical", """
with t as (select doc_id, unnest(regexp_extract_all(lower(text), '[^ \\t\\n\\r]+')) as word from documents),
tf as (select doc_id, word, count(*) as tf from t group by 1, 2),
q as (select distinct item_id as qid, unnest(regexp_extract_all(lower(text), '[^ \\t\\n\\r]+')) as word from benchmark),
w as (select word, ln(1.0::double + (select count(*) from documents) / count(*)::double) as weight from tf group by 1),
s as (select qid, doc_id, round(sum((1.0::double + ln(tf)) * weight), 6) as score
      from q join tf using (word) join w using (word) group by 1, 2),
r as (select *, row_number() over (partition by qid order by score desc, doc_id) as rank from s)
select qid, rank, doc_id, round(score, 3) as score, substr(text, 1, 500) as snippet
from r join documents using (doc_id) where rank <= 2""")
def txt_search_lexical(spark, d):
    docs = load(spark, d, "documents").select("doc_id", "text")
    asked = load(spark, d, "benchmark").select(F.col("item_id").alias("qid"), "text")
    found = stage(lexical.search(asked, spread(docs), 2), "found")
    return docs.join(small_side(found), "doc_id").select(
        "qid", "rank", "doc_id", F.round("score", 3).alias("score"), T.truncated(F.col("text"), 500).alias("snippet")
    )


@query("txt_stream_join", "select conv_id, turn, text from conversations")
def txt_stream_join(spark, d):
    messages = load(spark, d, "conversations").select("conv_id", "turn", "text")
    return tokens.joined(tokens.pieces(messages, ["conv_id", "turn"], "text", 7), ["conv_id", "turn"])


@query("txt_multimodal_msg", """
select page_id, 0::bigint as pos, 'text' as type, url as payload from pages
union all select page_id, 1, 'image_url', concat('data:image/jpeg;base64,', to_base64(encode(url))) from pages
union all select page_id, 2, 'image_url', concat('data:image/jpeg;base64,', to_base64(encode(html))) from pages""")
def txt_multimodal_msg(spark, d):
    pages = load(spark, d, "pages")
    uris = F.array(*[data_uri(F.encode(c, "UTF-8"), "image/jpeg") for c in ("url", "html")])
    rows = pages.select("page_id", F.posexplode(T.multimodal(F.col("url"), uris)).alias("pos", "p"))
    return rows.select(
        "page_id", F.col("pos").cast("bigint").alias("pos"), "p.type", F.coalesce("p.text", "p.image_url").alias("payload")
    )

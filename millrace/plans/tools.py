"""Tool-call data: conversion, checks, evaluation, dispatch."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from millrace.functions import formats, house
from millrace.functions.toolschema import call_text, json_type
from millrace.operators import splits, toolcalls as T
from millrace.operators.sizing import dealt
from millrace.plans.registry import query
from millrace.session import load
from millrace.sources import sinks
from millrace.sources.staging import fresh_path

# The raw rows are JSON texts built from ``part`` by one expression that both engines can read.
_LOOSE = """case p_size % 16 when 0 then 'str' when 1 then 'str, optional' when 2 then 'str, default=''Lisbon'''
  when 3 then 'default=''x''' when 4 then 'List[int]' when 5 then 'Tuple[int, int]' when 6 then 'Callable[[int], str]'
  when 7 then 'set' when 8 then 'Dict' when 9 then 'weird' when 10 then ' int ' when 11 then 'float, optional'
  when 12 then 'bool' when 13 then 'list' when 14 then 'Set[str]' else 'int, default=5, optional' end"""
_DEFAULT = "case p_size % 4 when 0 then '5' when 1 then '\"x\"' when 2 then '[1]' else '{\"a\":1}' end"
_WIDE = ",".join(f'"p{i}":{{"type":"int"}}' for i in range(1, 10))
_TOOLS = f"""concat('[{{"name":"find_', lower(p_type), '","description":"Find parts","parameters":{{"name":{{"type":"', {_LOOSE},
  '","description":"part name"}},"size":{{"type":"int","default":', {_DEFAULT}, '}},"brand":{{"description":"brand","default":""}},',
  '"color":{{"type":"str","default":null}},"note":{{"type":"str"}}}}}},',
  case when p_size > 45 then '{{"name":"wide","parameters":{{{_WIDE}}}}}' when p_size < 5 then '{{"name":"bare"}}'
       else '{{"name":"list_brands","description":"Lists brands","parameters":{{}}}}' end, ']')"""
_CALL = """concat('{"name":"find_', lower(p_type), '","arguments":{"name":"', p_name, '","size":', cast(p_size as TEXT_), '}}')"""
_ANSWERS = f"""case p_size % 5 when 0 then '[]' when 4 then concat('[', {_CALL}, ',{{"name":"list_brands","arguments":{{}}}}]')
  else concat('[', {_CALL}, ']') end"""
_QUERY = "concat('Find ', p_name, ' of size ', cast(p_size as TEXT_))"

RAW_SQL = (f"raw as (select p_partkey as id, {_QUERY} as query, {_TOOLS} as tools, {_ANSWERS} as answers, p_size, p_name, "
           f"p_type, p_partkey, {_LOOSE} as loose from part)").replace("TEXT_", "varchar")
ONE_SQL = RAW_SQL + ", one as (select * from raw where json_array_length(answers) = 1)"


def raw_rows(spark, d) -> DataFrame:
    def text(sql: str):
        return F.expr(sql.replace("TEXT_", "string"))
    return dealt(load(spark, d, "part").select("p_partkey", "p_name", "p_type", "p_size")).select(
        F.col("p_partkey").alias("id"), text(_QUERY).alias("query"), text(_TOOLS).alias("tools"), text(_ANSWERS).alias("answers"),
    )


def parsed_rows(spark, d) -> DataFrame:
    return T.parsed(raw_rows(spark, d))


_TYPE_SQL = """case when starts_with(t1, 'default=') then 'string' when starts_with(t2, 'Callable') then 'string'
  when starts_with(t2, 'Tuple') or starts_with(t2, 'List[') or starts_with(t2, 'Set') or t2 = 'set' then 'array'
  when t2 in ('int', 'integer') then 'integer' when t2 in ('float', 'number') then 'number'
  when t2 in ('bool', 'boolean') then 'boolean' when t2 in ('dict', 'Dict', 'object') then 'object'
  when t2 in ('list', 'List', 'array') then 'array' else 'string' end"""


def _typed_sql(source: str, loose: str, keep: str) -> str:
    return f"""n0 as (select {keep}, trim({loose}) as t0 from {source}),
n1 as (select *, case when contains(t0, ',') and contains(t0, 'default') then trim(split_part(t0, ',', 1)) else t0 end as t1 from n0),
n2 as (select *, trim(replace(t1, ', optional', '')) as t2 from n1)"""


@query("json_type_normalize", f"""with {RAW_SQL}, {_typed_sql('raw', 'loose', 'id, loose')}
select id, loose, {_TYPE_SQL} as json_type from n2""")
def json_type_normalize(spark, d):
    loose = load(spark, d, "part").select(F.col("p_partkey").alias("id"), F.expr(_LOOSE).alias("loose"))
    return loose.select("id", "loose", json_type(F.col("loose")).alias("json_type"))


@query("flt_single_call", f"with {ONE_SQL} select id, query from one")
def flt_single_call(spark, d):
    return T.single_call(parsed_rows(spark, d)).select("id", "query")


_SPECS_SQL = RAW_SQL + """,
tool as (select id, unnest(from_json(tools, '["json"]')) as t, unnest(range(json_array_length(tools)::bigint)) as pos from raw),
par as (select id, pos, json_extract_string(t, '$.name') as tool, coalesce(json_extract_string(t, '$.description'), '') as about,
          k, json_extract(t, '$.parameters.' || k) as info from tool, unnest(json_keys(t, '$.parameters')) u(k)),
dflt as (select *, json_extract(info, '$.default') as dv,
          coalesce(json_extract_string(info, '$.type'), 'str') as loose from par)"""


@query("json_convert_tools", f"""with {_SPECS_SQL},
{_typed_sql('dflt', 'loose', "id, pos, tool, about, k, coalesce(json_extract_string(info, '$.description'), '') as description, dv")}
select id, pos, tool, about, k as parameter, {_TYPE_SQL} as type, description,
  case when dv is not null and dv::varchar not in ('null', '""') then dv::varchar end as default_json,
  not (dv is not null and dv::varchar not in ('null', '""')) as required from n2""")
def json_convert_tools(spark, d):
    from millrace.functions.toolschema import function_specs
    specs = parsed_rows(spark, d).select("id", F.posexplode(function_specs(F.col("tools"))).alias("pos", "t"))
    body = F.col("t.function")
    rows = specs.select(
        "id", F.col("pos").cast("bigint").alias("pos"), body["name"].alias("tool"), body["description"].alias("about"),
        body["parameters"]["required"].alias("needed"), F.explode(body["parameters"]["properties"]).alias("parameter", "p"),
    )
    return rows.select(
        "id", "pos", "tool", "about", "parameter", "p.type", "p.description", F.to_json("p.default").alias("default_json"),
        F.array_contains("needed", F.col("parameter")).alias("required"),
    )


@query("flt_narrow_tools", f"with {ONE_SQL} select id from one where p_size <= 45")
def flt_narrow_tools(spark, d):
    return T.narrow_only(T.examples(parsed_rows(spark, d))).select("id")


@query("json_convert_example", f"""with {ONE_SQL}
select id, query as content, 'call_0' as call_id, concat('find_', lower(p_type)) as name, p_name as name_argument,
       p_size::bigint as size_argument, 2::bigint as n_tools, 2::bigint as n_messages from one""")
def json_convert_example(spark, d):
    call = F.col("messages")[1]["tool_calls"][0]
    given = call["function"]["arguments"]
    return T.examples(parsed_rows(spark, d)).select(
        "id", F.col("messages")[0]["content"].alias("content"), call["id"].alias("call_id"), call["function"]["name"].alias("name"),
        F.try_variant_get(given, "$.name", "string").alias("name_argument"),
        F.try_variant_get(given, "$.size", "bigint").alias("size_argument"),
        F.size("tools").cast("bigint").alias("n_tools"), F.size("messages").cast("bigint").alias("n_messages"),
    )


@query("json_eval_format", f"""with {ONE_SQL}
select id, 1::bigint as n_messages, query as content, concat('find_', lower(p_type)) as name, p_name as name_argument,
       p_size::bigint as size_argument, concat('find_', lower(p_type), case when p_size < 5 then ',bare' else ',list_brands' end) as tool_names,
       case when p_size < 5 then 0 else 1 end::bigint as described_tools
from one where p_size <= 45""")
def json_eval_format(spark, d):
    given = F.col("tool_calls")[0]["function"]["arguments"]
    described = F.size(F.filter(F.slice("tools", 2, 100), lambda t: t["function"]["description"] != ""))
    return T.eval_format(T.examples(parsed_rows(spark, d))).select(
        "id", F.size("messages").cast("bigint").alias("n_messages"), F.col("messages")[0]["content"].alias("content"),
        F.col("tool_calls")[0]["function"]["name"].alias("name"),
        F.try_variant_get(given, "$.name", "string").alias("name_argument"), F.try_variant_get(given, "$.size", "bigint").alias("size_argument"),
        F.array_join(F.transform("tools", lambda t: t["function"]["name"]), ",").alias("tool_names"), described.cast("bigint").alias("described_tools"),
    )


# Raw rows as they may come: every 7th has unreadable tools or answers, or a parameter that is plain text.
_BROKEN = {"tools": "case when p_partkey % 21 = 7 then substr(tools, 1, length(tools) - 3) when p_partkey % 21 = 14 then "
                    "replace(tools, '\"note\":{\"type\":\"str\"}', '\"note\":\"a note\"') else tools end",
           "answers": "case when p_partkey % 21 = 0 then concat(answers, ',') else answers end"}
_PROBLEMS = ["tools are not readable", "a parameter is not described by an object", "answers are not readable"]
_BROKEN_SQL = f"""loose as (select id, {_BROKEN['tools']} as tools, {_BROKEN['answers']} as answers from raw),
par as (select id, unnest(json_keys(t, '$.parameters')) as k, t from (
  select id, unnest(from_json(tools, '["json"]')) as t from loose where json_valid(tools))),
odd as (select distinct id from par where json_type(t, '$.parameters.' || k) <> 'OBJECT'),
said as (select id, case when not json_valid(tools) then '{_PROBLEMS[0]}' when id in (select id from odd) then '{_PROBLEMS[1]}'
  when not json_valid(answers) then '{_PROBLEMS[2]}' end as problem from loose)"""


def broken_rows(spark, d) -> DataFrame:
    return raw_rows(spark, d).withColumn("p_partkey", F.col("id")).selectExpr(
        "id", "query", f"{_BROKEN['tools']} as tools", f"{_BROKEN['answers']} as answers")


_CHECKS = {
    "messages and tools present": "one", "user turn first": "one", "assistant turn has tool calls": "one",
    "exactly one call": "one", "call has name and arguments": "one", "tools are function specs": "one",
    "types are JSON Schema types": "one", "truth is outside messages": "narrow", "tool calls filled": "narrow",
    "no tool is too wide": "narrow",
}


@query("chk_tool_rows", f"with {ONE_SQL}, {_BROKEN_SQL}, narrow as (select * from one where p_size <= 45) " + " union all ".join(
    f"select '{c}' as \"check\", count(*) as rows, count(*) filter (where id is null) as bad from {t}" for c, t in _CHECKS.items()) + "".join(
    f" union all select '{p}', count(*), count(*) filter (where problem = '{p}') from said" for p in _PROBLEMS))
def chk_tool_rows(spark, d):
    rows = T.examples(parsed_rows(spark, d))
    return (T.check_training(rows).unionByName(T.check_evaluation(T.eval_format(rows)))
            .unionByName(T.check_raw(broken_rows(spark, d), _PROBLEMS)))


@query("snk_jsonl_splits", f"""with {ONE_SQL}, c as (select id, p_size, query, p_type from one order by id limit 3000),
r as (select *, row_number() over (order by md5(concat('1234:', id::varchar)), id) as place from c),
n as (select least(1500, count(*)) as n from c),
s as (select *, case when place <= floor(0.70 * n) then 'training'
    when place <= floor(0.70 * n) + floor(0.15 * n) then 'validation' else 'testing' end as split from r, n where place <= n)
select split, count(*) as lines, count(*) as valid, min(query) as first_content, max(query) as last_content, sum(length(query))::bigint as content_chars,
       count(distinct concat('find_', lower(p_type))) as tools_called, count(*) filter (where split = 'testing') as truths
from s where split <> 'testing' or p_size <= 45 group by 1""")
def snk_jsonl_splits(spark, d):
    drawn = splits.draw_and_split(T.examples(parsed_rows(spark, d)), "id")
    path = fresh_path(spark, "splits")
    sinks.write_lines(T.split_lines(drawn), path)
    line = F.col("value")
    content = F.get_json_object(line, "$.messages[0].content")
    # the call is the truth beside the messages of a test line, and the last message of another
    truth = F.get_json_object(line, "$.tool_calls[0].function.name")
    called = F.coalesce(truth, F.get_json_object(line, "$.messages[1].tool_calls[0].function.name"))
    return sinks.read_lines(spark, path).groupBy("split").agg(
        F.count("*").alias("lines"), F.count(F.get_json_object(line, "$.messages")).alias("valid"), F.min(content).alias("first_content"),
        F.max(content).alias("last_content"), F.sum(F.length(content)).alias("content_chars"), F.countDistinct(called).alias("tools_called"),
        F.count(truth).alias("truths"),
    )


# Predictions: what two models might have answered, one kind of answer per example.
_PREDICTED = [
    "id as example_id", "model", "case when kind = 4 then 'other_fn' when kind < 4 then name end as name",
    """case when kind in (0, 4) then concat('{"name":"', p_name, '","size":', cast(p_size as string), '}')
       when kind = 1 then concat('{"size":', cast(p_size as string), ', "name":"', p_name, '"}')
       when kind = 2 then concat('{"name":"', p_name, '","size":"', cast(p_size as string), '"}')
       when kind = 3 then concat('{"name":"', p_name, '","size":', cast(p_size as string), '.0}') end as arguments""",
    "case when kind = 6 then 'request timed out' end as error",
]

JUDGED_SQL = ONE_SQL + """, kinds as (
  select id as example_id, concat('find_', lower(p_type)) as name, 'base' as model, id % 7 as kind from one
  union all select id, concat('find_', lower(p_type)), 'tuned', id % 4 from one),
judged as (select *, kind < 4 as name_ok, kind in (0, 1, 3) as all_ok,
  case when kind = 6 then 'ERR' when kind < 4 then 'OK' else 'MISS' end as verdict from kinds)"""


ANSWERING = ["base", "tuned"]


def predictions(spark, d) -> DataFrame:
    rows = load(spark, d, "part").select(
        F.col("p_partkey").alias("id"), "p_name", "p_size", F.concat(F.lit("find_"), F.lower("p_type")).alias("name"),
        F.explode(F.array(F.lit("base"), F.lit("tuned"))).alias("model"),
    ).filter("p_size % 5 not in (0, 4)")
    # kind 5 has not been answered at all: no row
    kinds = rows.withColumn("kind", F.expr("id % case model when 'base' then 7 else 4 end")).filter("kind <> 5")
    return kinds.selectExpr(*_PREDICTED)


def judged_rows(spark, d) -> DataFrame:
    return T.verdicts(T.truths(parsed_rows(spark, d)), predictions(spark, d), ANSWERING)


@query("join_truth_prediction", f"with {JUDGED_SQL} select example_id, model, name, verdict from judged")
def join_truth_prediction(spark, d):
    return judged_rows(spark, d).select("example_id", "model", "name", "verdict")


@query("json_args_equal", f"with {JUDGED_SQL} select example_id, model, kind in (0, 1, 3, 4) as equal from judged")
def json_args_equal(spark, d):
    from millrace.functions.toolschema import same_json
    rows = judged_rows(spark, d)
    return rows.select("example_id", "model", same_json(F.col("arguments"), F.col("called_with")).alias("equal"))


_ACC_SQL = JUDGED_SQL + """, acc as (select model, count(*) as examples, avg(name_ok::int) as function_name_accuracy,
  avg(all_ok::int) as function_name_and_args_accuracy from judged group by 1)"""


@query("agg_tool_accuracy", f"""with {_ACC_SQL}, few as (select model, avg(name_ok::int) as n, avg(all_ok::int) as a
  from judged where example_id in (select id from one order by id limit 50) group by 1)
select model, examples, round(function_name_accuracy, 6) as function_name_accuracy,
  round(function_name_and_args_accuracy, 6) as function_name_and_args_accuracy,
  round(n, 6) as first_50_name_accuracy, round(a, 6) as first_50_name_and_args_accuracy from acc join few using (model)""")
def agg_tool_accuracy(spark, d):
    truth, told = T.truths(parsed_rows(spark, d)), predictions(spark, d)
    everything = T.accuracy(T.verdicts(truth, told, ANSWERING))
    first = T.accuracy(T.verdicts(T.first_examples(truth, 50), told, ANSWERING)).select(
        "model", F.col("function_name_accuracy").alias("first_50_name_accuracy"),
        F.col("function_name_and_args_accuracy").alias("first_50_name_and_args_accuracy"),
    )
    both = everything.join(first, "model")
    return both.select("model", "examples", *[F.round(c, 6).alias(c) for c in both.columns if c.endswith("accuracy")])


@query("agg_base_vs_tuned", f"""with {_ACC_SQL}, m as (
  select 'Function name' as metric, max(case when model = 'base' then function_name_accuracy end) as b,
         max(case when model = 'tuned' then function_name_accuracy end) as t from acc
  union all select 'Function name + arguments', max(case when model = 'base' then function_name_and_args_accuracy end),
         max(case when model = 'tuned' then function_name_and_args_accuracy end) from acc)
select metric, printf('%.1f%%', b * 100) as base, printf('%.1f%%', t * 100) as tuned,
       printf('%+.1f%%', (t - b) * 100) as improvement from m""")
def agg_base_vs_tuned(spark, d):
    compared = T.base_vs_tuned(T.accuracy(judged_rows(spark, d)))
    return compared.select(
        "metric", formats.percent(F.col("base")).alias("base"), formats.percent(F.col("tuned")).alias("tuned"),
        formats.signed_percent(F.col("improvement")).alias("improvement"),
    )


@query("chk_eval_gates", f"""with {_ACC_SQL}, m as (
  select max(case when model = 'base' then function_name_accuracy end) as b,
         max(case when model = 'tuned' then function_name_accuracy end) as t from acc)
select 'tuned beats base' as gate, t > b as passed from m union all select 'tuned reaches 0.60', t >= 0.60 from m
union all select 'base stays within 0.50', b <= 0.50 from m""")
def chk_eval_gates(spark, d):
    return T.eval_gates(T.base_vs_tuned(T.accuracy(judged_rows(spark, d))))


@query("llm_side_by_side", f"""with {JUDGED_SQL}
select example_id, name, max(case when model = 'base' then verdict end) as base,
       max(case when model = 'tuned' then verdict end) as tuned from judged group by 1, 2""")
def llm_side_by_side(spark, d):
    return T.side_by_side(judged_rows(spark, d), ANSWERING)


@query("flt_own_models", """
select distinct concat(p_brand, '/', p_name) as model_id from part where contains(concat(p_brand, '/', p_name), 'Brand#1')""")
def flt_own_models(spark, d):
    listed = load(spark, d, "part").select(F.concat("p_brand", F.lit("/"), "p_name").alias("model_id")).distinct()
    return T.own_models(listed, "Brand#1")


_CALLS_SQL = RAW_SQL + """, calls as (
  select id as turn, 0::bigint as call, concat('find_', lower(p_type)) as name, p_name, p_size from raw where p_size % 5 <> 0
  union all select id, 1, 'list_brands', p_name, p_size from raw where p_size % 5 = 4)"""


def _calls(spark, d) -> DataFrame:
    rows = raw_rows(spark, d).withColumn(
        "answers", F.from_json("answers", "array<struct<name string, arguments map<string, string>>>")
    )
    return rows.select(F.col("id").alias("turn"), F.posexplode("answers").alias("call", "c")).select(
        "turn", F.col("call").cast("bigint").alias("call"), "c.name", "c.arguments"
    )


@query("txt_call_format", f"""with {_CALLS_SQL}
select turn, call, case when call = 0 then concat(name, '(name=', p_name, ', size=', p_size::varchar, ')')
       else 'list_brands()' end as text from calls""")
def txt_call_format(spark, d):
    return _calls(spark, d).select("turn", "call", call_text(F.col("name"), F.col("arguments")).alias("text"))


def _responses(spark, d) -> DataFrame:
    """One answer per called function of a turn; every second turn got none for its search."""
    parts = load(spark, d, "part")
    found = parts.filter("p_size % 2 = 0").select(
        F.col("p_partkey").alias("turn"), F.concat(F.lit("find_"), F.lower("p_type")).alias("name"),
        F.concat(F.lit("found "), "p_name").alias("response"),
    )
    brands = parts.select(F.col("p_partkey").alias("turn"), F.lit("list_brands").alias("name"), F.col("p_brand").alias("response"))
    again = F.explode(F.when(F.col("turn") % 3 == 0, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("part")
    return found.unionByName(brands).select("turn", "name", again, "response").withColumn(
        "response", F.when(F.col("part") == 1, F.concat("response", F.lit(" again"))).otherwise(F.col("response")))


_RESPONSES_SQL = """resp as (
  select p_partkey as turn, concat('find_', lower(p_type)) as name, concat('found ', p_name) as response from part where p_size % 2 = 0
  union all select p_partkey, 'list_brands', p_brand from part),
called as (select turn, call, name, 0 as nth from calls union all
  select turn, call + 10, name, 1 from calls where turn % 3 = 0)"""


@query("join_call_response", f"""with {_CALLS_SQL}, {_RESPONSES_SQL}
select called.turn, call, called.name, case when nth = 1 then response || ' again' else response end as response
from called left join resp on called.turn = resp.turn and called.name = resp.name""")
def join_call_response(spark, d):
    # every third turn makes all its calls once more
    calls = _calls(spark, d)
    twice = calls.filter("turn % 3 = 0").withColumn("call", F.col("call") + 10)
    return T.with_responses(calls.unionByName(twice), _responses(spark, d)).select("turn", "call", "name", "response")


@query("json_call_log", f"""with {_CALLS_SQL}
select id as conv_id, 0::bigint as turn, 0::bigint as part, 'user' as role, 'text' as kind, query as payload from raw
union all select turn, 1, call, 'model', 'call', case when call = 0
  then concat(name, '(name=', p_name, ', size=', p_size::varchar, ')') else 'list_brands()' end from calls
union all select turn, 2, call, 'user', 'response', concat(name, ' -> done') from calls""")
def json_call_log(spark, d):
    rows = raw_rows(spark, d).withColumn(
        "answers", F.from_json("answers", "array<struct<name string, arguments map<string, string>>>")
    )
    none_call = F.lit(None).cast("struct<name:string,args:map<string,string>>")
    none_resp = F.lit(None).cast("struct<name:string,response:string>")

    def part(text, call, response):
        return F.struct(text.alias("text"), call.alias("function_call"), response.alias("function_response"))

    no_text = F.lit(None).cast("string")
    asked = F.array(part(F.col("query"), none_call, none_resp))
    called = F.transform("answers", lambda c: part(
        no_text, F.struct(c["name"].alias("name"), c["arguments"].alias("args")), none_resp))
    replied = F.transform("answers", lambda c: part(
        no_text, none_call, F.struct(c["name"].alias("name"), F.lit("done").alias("response"))))
    turns = F.array(*[
        F.struct(F.lit(i).cast("bigint").alias("turn"), F.lit(role).alias("role"), parts.alias("parts"))
        for i, (role, parts) in enumerate([("user", asked), ("model", called), ("user", replied)])
    ])
    history = rows.select(F.col("id").alias("conv_id"), F.explode(turns).alias("t")).select("conv_id", "t.turn", "t.role", "t.parts")
    return T.call_log(history)


_NAMED = """case o_orderkey % 5 when 0 then 'add' when 1 then 'power_disco_ball' when 2 then 'start_music'
  when 3 then 'dim_lights' else 'open_window' end"""


def house_calls(spark, d) -> DataFrame:
    arguments = """case o_orderkey % 5 when 0 then to_json(named_struct('a', o_orderkey, 'b', o_custkey))
      when 1 then to_json(named_struct('power', o_orderstatus = 'O'))
      when 2 then to_json(named_struct('energetic', true, 'loud', false, 'bpm', 120))
      when 3 then to_json(named_struct('brightness', 0.5D)) else '{}' end"""
    return load(spark, d, "orders").select(
        F.col("o_orderkey").alias("call_id"), F.expr(_NAMED).alias("name"), F.expr(arguments).alias("arguments")
    )


@query("udf_tool_dispatch", f"""
with c as (select o_orderkey as call_id, {_NAMED} as name, o_orderkey + o_custkey as total from orders)
select call_id, name, case name when 'add' then total::varchar when 'start_music' then '"Never gonna give you up."'
    when 'open_window' then null else 'true' end as result,
  case when name = 'open_window' then 'unknown function open_window' end as error from c""")
def udf_tool_dispatch(spark, d):
    done = house_calls(spark, d).withColumn("r", house.Registry(house.HOUSE).dispatch(F.col("name"), F.col("arguments")))
    return done.select("call_id", "name", "r.result", "r.error")


@query("udf_tool_registry", f"""
with s(name, position, argument, type) as (values ('add', 1::bigint, 'a', 'int'), ('add', 2, 'b', 'int'),
  ('power_disco_ball', 1, 'power', 'bool'), ('start_music', 1, 'energetic', 'bool'), ('start_music', 2, 'loud', 'bool'),
  ('start_music', 3, 'bpm', 'int'), ('dim_lights', 1, 'brightness', 'float')),
c as (select {_NAMED} as name, count(*) as calls from orders group by 1)
select s.*, coalesce(calls, 0) as calls from s left join c using (name)""")
def udf_tool_registry(spark, d):
    tools = house.Registry(house.HOUSE)
    tools.register(spark)
    used = house_calls(spark, d).groupBy("name").agg(F.count("*").alias("calls"))
    return tools.signatures(spark).join(used, "name", "left").fillna(0, subset=["calls"])

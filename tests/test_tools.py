"""Tool-call conversion on the awkward literals."""

import json

import pytest
from pyspark.sql import functions as F

from millrace.functions.house import HOUSE, Registry
from millrace.functions.toolschema import JSON_TYPES, call_text, function_specs, json_type, same_json
from millrace.operators import toolcalls as T


@pytest.mark.parametrize("loose,want", [
    ("str", "string"), ("str, optional", "string"), ("str, default='Lisbon'", "string"), ("default='x'", "string"),
    ("List[int]", "array"), ("Tuple[int, int]", "array"), ("Callable[[int], str]", "string"), ("set", "array"),
    ("Set[str]", "array"), ("Dict", "object"), ("weird", "string"), (" int ", "integer"), ("float, optional", "number"),
    ("int, default=5, optional", "integer"), ("bool", "boolean"), ("", "string"), ("default=5", "string"),
    ("int, optional, default=3", "integer"), ("settings", "string"),
])
def test_json_type(spark, loose, want):
    assert spark.createDataFrame([(loose,)], "t string").select(json_type(F.col("t"))).first()[0] == want


def test_every_known_name(spark):
    rows = spark.createDataFrame(list(JSON_TYPES.items()), "loose string, want string")
    assert rows.filter(json_type(F.col("loose")) != F.col("want")).isEmpty()


TOOLS = [
    {"name": "f", "description": "d", "parameters": {
        "a": {"type": "int", "default": 5}, "b": {"type": "str", "default": ""}, "c": {"type": "List[int]", "default": [1]},
        "d": {"default": None, "description": "dd"}, "e": {"type": "bool", "default": False}, "z": {"type": "float", "default": 0}}},
    {"name": "bare"},
    {"name": "nothing", "parameters": None},
]


def row(i, answers, tools=TOOLS):
    return (i, f"ask {i}", json.dumps(tools), json.dumps(answers))


@pytest.fixture(scope="module")
def rows(spark):
    wide = [{"name": "w", "parameters": {f"p{i}": {"type": "int"} for i in range(9)}}]
    call = {"name": "f", "arguments": {"a": 1, "c": [1, 2]}}
    data = [row(0, []), row(1, [call]), row(2, [call, call]), row(3, [call], wide)]
    return T.parsed(spark.createDataFrame(data, "id bigint, query string, tools string, answers string"))


def test_defaults_and_required(rows):
    specs = rows.filter("id = 1").select(F.to_json(function_specs(F.col("tools")))).first()[0]
    f, bare, nothing = (s["function"] for s in json.loads(specs))
    assert f["parameters"]["required"] == ["b", "d"]
    assert f["parameters"]["properties"]["a"] == {"type": "integer", "description": "", "default": 5}
    assert f["parameters"]["properties"]["c"] == {"type": "array", "description": "", "default": [1]}
    assert f["parameters"]["properties"]["d"] == {"type": "string", "description": "dd"}
    assert f["parameters"]["properties"]["e"]["default"] is False and f["parameters"]["properties"]["z"]["default"] == 0
    for empty in (bare, nothing):
        assert empty["parameters"] == {"type": "object", "properties": {}, "required": []} and empty["description"] == ""


def test_examples_keep_single_calls(rows):
    made = T.examples(rows)
    assert sorted(r.id for r in made.collect()) == [1, 3]
    first = json.loads(made.filter("id = 1").select(F.to_json("messages")).first()[0])
    assert first[0] == {"role": "user", "content": "ask 1"}
    assert first[1] == {"role": "assistant", "tool_calls": [
        {"id": "call_0", "type": "function", "function": {"name": "f", "arguments": {"a": 1, "c": [1, 2]}}}]}


def test_eval_format_lifts_the_call_and_drops_wide_tools(rows):
    only = T.eval_format(T.examples(rows)).collect()
    assert [r.id for r in only] == [1]
    assert [m.role for m in only[0].messages] == ["user"] and only[0].tool_calls[0].function.name == "f"


def test_split_lines(rows):
    drawn = T.examples(rows).withColumn("split", F.explode(F.array(F.lit("training"), F.lit("testing"))))
    lines = [(r.split, json.loads(r.value)) for r in T.split_lines(drawn).collect()]
    assert sorted(s for s, _ in lines) == ["testing", "training", "training"]
    for split, line in lines:
        assert ("tool_calls" in line) == (split == "testing")


def test_checks_find_bad_rows(rows):
    good = T.examples(rows)
    bad = good.withColumn("messages", F.reverse("messages"))
    counts = {r.check: r.bad for r in T.check_training(good.unionByName(bad)).collect()}
    assert counts["messages and tools present"] == 0 and counts["user turn first"] == 2 and counts["exactly one call"] == 2
    wide = good.select("id", "messages", "tools", F.col("messages")[1]["tool_calls"].alias("tool_calls"))
    counts = {r.check: r.bad for r in T.check_evaluation(wide).collect()}
    assert counts == {"truth is outside messages": 2, "tool calls filled": 0, "no tool is too wide": 1}


@pytest.mark.parametrize("a,b,same", [
    ('{"a":1,"b":{"c":2,"d":[1,2]}}', '{"b":{"d":[1,2],"c":2},"a":1}', True), ('{"a":1}', '{"a":"1"}', False),
    ('{"a":1}', '{"a":1.0}', True), ('[1,2]', '[2,1]', False), ('{"a":1}', None, False), ('{"a":1}', "{broken", False),
])
def test_same_json(spark, a, b, same):
    assert spark.createDataFrame([(a, b)], "a string, b string").select(same_json(F.col("a"), F.col("b"))).first()[0] is same


def test_verdicts_accuracy_and_gates(spark):
    truth = spark.createDataFrame([(i, "f", '{"a":1}') for i in range(4)], "example_id bigint, name string, arguments string")
    told = spark.createDataFrame([
        (0, "base", "f", '{"a":1}', None), (1, "base", "g", '{"a":1}', None), (2, "base", None, None, None), (3, "base", None, None, "boom"),
        (0, "tuned", "f", '{"a":1}', None), (1, "tuned", "f", '{"a":2}', None), (2, "tuned", "f", '{"a":1}', None), (3, "tuned", "f", '{"a":1.0}', None),
    ], "example_id bigint, model string, name string, arguments string, error string")
    judged = T.verdicts(truth, told, ["base", "tuned"])
    side = {r.example_id: (r.base, r.tuned) for r in T.side_by_side(judged, ["base", "tuned"]).collect()}
    assert side == {0: ("OK", "OK"), 1: ("MISS", "OK"), 2: ("MISS", "OK"), 3: ("ERR", "OK")}
    acc = {r.model: (r.function_name_accuracy, r.function_name_and_args_accuracy) for r in T.accuracy(judged).collect()}
    assert acc == {"base": (0.25, 0.25), "tuned": (1.0, 0.75)}
    compared = T.base_vs_tuned(T.accuracy(judged))
    assert all(r.passed for r in T.eval_gates(compared).collect())
    swapped = T.base_vs_tuned(T.accuracy(judged), base="tuned", tuned="base")
    assert not any(r.passed for r in T.eval_gates(swapped).collect())


def test_call_text(spark):
    one = spark.createDataFrame([("f", {"a": "1", "b": "x"}), ("g", {})], "n string, a map<string,string>")
    assert [r[0] for r in one.select(call_text(F.col("n"), F.col("a"))).collect()] == ["f(a=1, b=x)", "g()"]


def test_own_models(spark):
    listed = spark.createDataFrame([("me/a",), ("you/b",)], "model_id string")
    assert [r[0] for r in T.own_models(listed, "me", ["me/a"]).collect()] == ["me/a"]
    with pytest.raises(LookupError, match="me/z"):
        T.own_models(listed, "me", ["me/z"])


def test_dispatch_and_sql_functions(spark):
    tools = Registry(HOUSE)
    calls = spark.createDataFrame([
        ("add", '{"a": 57, "b": 22}'), ("dim_lights", '{"brightness": 0.3}'), ("fly", "{}"), ("add", '{"a": 1}'), ("add", "{oops"),
    ], "name string, arguments string")
    got = [tuple(r.r) for r in calls.select(tools.dispatch(F.col("name"), F.col("arguments")).alias("r")).collect()]
    assert got == [("79", None), ("true", None), (None, "unknown function fly"), (None, "TypeError"), (None, "JSONDecodeError")]
    tools.register(spark)
    assert spark.sql("select add(57, 22)").first()[0] == 79
    assert tools.signatures(spark).filter("name = 'start_music'").count() == 3


def test_unanswered_examples_count(spark):
    truth = spark.createDataFrame([(i, "f", "{}") for i in range(4)], "example_id bigint, name string, arguments string")
    told = spark.createDataFrame([(0, "base", "f", "{}", None)], "example_id bigint, model string, name string, arguments string, error string")
    judged = T.verdicts(truth, told, ["base", "tuned"])
    got = {r.model: (r.examples, r.function_name_accuracy) for r in T.accuracy(judged).collect()}
    assert got == {"base": (4, 0.25), "tuned": (4, 0.0)}
    assert {(r.base, r.tuned) for r in T.side_by_side(judged, ["base", "tuned"]).collect()} == {("OK", "MISS"), ("MISS", "MISS")}


def test_a_function_called_twice(spark):
    calls = spark.createDataFrame([(1, 0, "f"), (1, 1, "g"), (1, 2, "f"), (1, 3, "f")], "turn bigint, call bigint, name string")
    said = spark.createDataFrame([(1, "f", 1, "second"), (1, "f", 0, "first"), (2, "f", 0, "other")],
                                 "turn bigint, name string, part bigint, response string")
    got = sorted((r.call, r.response) for r in T.with_responses(calls, said).collect())
    assert got == [(0, "first"), (1, None), (2, "second"), (3, None)]


@pytest.mark.parametrize("tools,answers,problem", [
    ("[]", "[]", None), ('[{"name":"f"}]', '[{"name":"f","arguments":{}}]', None),
    ('[{"name":"f","parameters":{"a":"text"}}]', "[]", "a parameter is not described by an object"),
    ('[{"name":"f","parameters":"text"}]', "[]", "a parameter is not described by an object"),
    ("[{", "[]", "tools are not readable"), (None, "[]", "tools are not readable"), ('{"name":"f"}', "[]", "tools are not readable"),
    ("[]", "[},", "answers are not readable"), ("[]", "[],", "answers are not readable"), ("[]", None, "answers are not readable"),
])
def test_broken_rows_are_errors(spark, tools, answers, problem):
    raw = spark.createDataFrame([(1, "q", tools, answers)], "id bigint, query string, tools string, answers string")
    assert T.with_problems(raw).first().problem == problem
    if problem:
        with pytest.raises(Exception, match=problem):
            T.parsed(raw).collect()
    else:
        assert T.parsed(raw).count() == 1


def test_specifications_are_made_once(spark):
    """Filters and checks read the finished tools; they do not parse them anew."""
    from millrace.operators import toolcalls

    raw = spark.createDataFrame([(1, "q", '[{"name":"f","parameters":{"a":{"type":"int"}}}]', '[{"name":"f","arguments":{"a":1}}]')],
                                "id long, query string, tools string, answers string")
    made = toolcalls.eval_format(toolcalls.examples(toolcalls.parsed(raw)))
    assert made._jdf.queryExecution().optimizedPlan().toString().count("transform_values") == 1
    assert made.first().tools[0]["function"]["parameters"]["required"] == ["a"]


def test_rows_of_one_piece_are_dealt_to_all_cores(spark):
    from millrace.operators.sizing import dealt

    cores = spark.sparkContext.defaultParallelism
    many = dealt(spark.range(50_000).coalesce(1))
    assert many.rdd.getNumPartitions() == cores and many.count() == 50_000
    assert dealt(spark.range(100).coalesce(1)).rdd.getNumPartitions() == 1

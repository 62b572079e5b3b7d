"""Raw tool-call rows to training and evaluation examples, and how well models answer them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from millrace.functions.toolschema import RAW_ANSWERS, RAW_TOOLS, SIX_TYPES, function_specs, same_json
from millrace.operators.sizing import computed_once

WIDEST_TOOL = 8


# What is to be read of the raw texts, as far as its shape goes.
_LOOSE_TOOLS = "array<struct<name string, parameters variant>>"


def problem(tools: Column, answers: Column) -> Column:
    """Why the raw JSON texts of a row cannot be used; null where they can. Given are the texts as ``_LOOSE_TOOLS`` and ``RAW_ANSWERS``."""

    def is_map(v: Column) -> Column:
        return F.schema_of_variant(v).startswith("OBJECT")

    def described(v: Column) -> Column:
        return F.forall(F.map_values(F.try_variant_get(v, "$", "map<string, variant>")), is_map)

    shaped = F.forall(tools, lambda t: t["parameters"].isNull() | F.is_variant_null(t["parameters"]) | F.when(is_map(t["parameters"]), described(t["parameters"])).otherwise(False))
    def closed(text: str) -> Column:  # the parser takes no notice of what follows an array
        return F.rtrim(F.col(text)).endswith("]") & F.try_parse_json(text).isNotNull()

    readable = closed("tools") & tools.isNotNull() & F.forall(tools, lambda t: t.isNotNull())
    answered = closed("answers") & answers.isNotNull() & F.forall(answers, lambda a: a.isNotNull())
    return (F.when(~F.coalesce(readable, F.lit(False)), "tools are not readable")
            .when(~F.coalesce(shaped, F.lit(False)), "a parameter is not described by an object")
            .when(~F.coalesce(answered, F.lit(False)), "answers are not readable"))


def with_problems(raw: DataFrame) -> DataFrame:
    """Adds ``problem`` to raw rows."""
    # columns that several rules read are neither copied into them nor made where nobody asks for ``problem``
    read = raw.withColumns({"_loose_tools": F.from_json("tools", _LOOSE_TOOLS), "_loose_answers": F.from_json("answers", RAW_ANSWERS)})
    return read.withColumn("problem", problem(F.col("_loose_tools"), F.col("_loose_answers"))).drop("_loose_tools", "_loose_answers")


def parsed(raw: DataFrame) -> DataFrame:
    """(id, query, tools, answers) with the two JSON texts as typed values; free values stay variants.

    A row that cannot be read is an error, never a row that vanishes or loses its tools; ``with_problems`` tells
    such rows beforehand.
    """
    why = F.col("problem")
    checked = F.when(why.isNotNull(), F.raise_error(F.concat(F.lit("row "), F.col("id").cast("string"), F.lit(": "), why)))
    return with_problems(raw).withColumn("tools", F.coalesce(checked.cast("string"), F.col("tools"))).drop("problem").withColumns({"tools": F.from_json("tools", RAW_TOOLS), "answers": F.from_json("answers", RAW_ANSWERS)})


def single_call(rows: DataFrame) -> DataFrame:
    return rows.filter(F.size("answers") == 1)


def examples(rows: DataFrame) -> DataFrame:
    """(id, messages, tools): one user turn and one assistant turn with one call; others are left out."""
    answer, called = F.col("answers")[0], F.col("_answer")
    call = F.struct(
        F.lit("call_0").alias("id"), F.lit("function").alias("type"),
        F.struct(called["name"].alias("name"), called["arguments"].alias("arguments")).alias("function"),
    )
    no_calls = F.lit(None).cast("array<struct<id:string,type:string,function:struct<name:string,arguments:variant>>>")

    def turn(role: str, content: Column, calls: Column) -> Column:
        return F.struct(F.lit(role).alias("role"), content.alias("content"), calls.alias("tool_calls"))

    made = computed_once(single_call(rows), "_answer", answer).select(
        "id",
        F.array(
            turn("user", F.col("query"), no_calls), turn("assistant", F.lit(None).cast("string"), F.array(call))
        ).alias("messages"),
        F.col("tools").alias("_raw"),
    )
    # specifications are read by many checks and filters, and made and parsed once
    return computed_once(made, "tools", function_specs(F.col("_raw"))).drop("_raw")


def _narrow(widest: int) -> Column:
    return F.forall("tools", lambda t: F.size(F.map_keys(t["function"]["parameters"]["properties"])) <= widest)


def narrow_only(rows: DataFrame, widest: int = WIDEST_TOOL) -> DataFrame:
    """Rows none of whose tools has more than ``widest`` properties."""
    return rows.filter(_narrow(widest))


def _lifted() -> tuple[Column, Column]:
    """(messages without the answering turn, the calls of that turn)."""
    def is_answer(m: Column) -> Column:
        return (m["role"] == "assistant") & m["tool_calls"].isNotNull()

    answers = F.filter("messages", is_answer)
    asked = F.transform(
        F.filter("messages", lambda m: ~is_answer(m)),
        lambda m: F.struct(m["role"].alias("role"), m["content"].alias("content")),
    )
    return asked, F.get(answers, F.size(answers) - 1)["tool_calls"]


def eval_format(rows: DataFrame) -> DataFrame:
    """The expected calls move out of the messages into a field of their own; wide tools drop the row."""
    asked, answers = _lifted()
    return narrow_only(rows).select("id", asked.alias("messages"), "tools", answers.alias("tool_calls"))


def split_lines(drawn: DataFrame) -> DataFrame:
    """(split, value): every drawn example as one JSON line; ``testing`` in evaluation format.

    All splits come out of one pass over the examples, so they are read and converted once.
    """
    asked, answers = _lifted()
    training = F.to_json(F.struct("messages", "tools"))
    evaluation = F.to_json(F.struct(asked.alias("messages"), "tools", answers.alias("tool_calls")))
    is_test = F.col("split") == "testing"
    return drawn.filter(~is_test | _narrow(WIDEST_TOOL)).select(
        "split", F.when(is_test, evaluation).otherwise(training).alias("value")
    )


def truths(rows: DataFrame) -> DataFrame:
    """(example_id, name, arguments as JSON text) of the expected call."""
    call = F.col("answers")[0]
    return single_call(rows).select(
        F.col("id").alias("example_id"), call["name"].alias("name"), F.to_json(call["arguments"]).alias("arguments")
    )


def verdicts(truth: DataFrame, predictions: DataFrame, models: list[str]) -> DataFrame:
    """Every truth beside the first call of each of the models: OK, MISS (other call or none) or ERR.

    ``predictions`` is (example_id, model, name, arguments, error) with at most one row per example and model. An
    example that a model did not answer is a MISS like any other, and counts.
    """
    truth = truth.withColumn("model", F.explode(F.array(*[F.lit(m) for m in models])))
    told = predictions.select(
        "example_id", "model", F.col("name").alias("called"), F.col("arguments").alias("called_with"), "error"
    )
    both = truth.join(told, ["example_id", "model"], "left")
    name_ok = F.coalesce((F.col("called") == F.col("name")) & F.col("error").isNull(), F.lit(False))
    return both.withColumns({
        "verdict": F.when(F.col("error").isNotNull(), "ERR").when(name_ok, "OK").otherwise("MISS"),
        "name_ok": name_ok,
        "all_ok": name_ok & same_json(F.col("arguments"), F.col("called_with")),
    })


def accuracy(judged: DataFrame) -> DataFrame:
    """(model, examples, name accuracy, name and arguments accuracy)."""
    return judged.groupBy("model").agg(
        F.count("*").alias("examples"),
        F.avg(F.col("name_ok").cast("double")).alias("function_name_accuracy"),
        F.avg(F.col("all_ok").cast("double")).alias("function_name_and_args_accuracy"),
    )


def first_examples(truth: DataFrame, n: int = 50) -> DataFrame:
    """The first n examples by id, the ones a limited evaluation looks at."""
    return truth.orderBy("example_id").limit(n)


METRICS = {
    "Function name": "function_name_accuracy",
    "Function name + arguments": "function_name_and_args_accuracy",
}


def base_vs_tuned(scores: DataFrame, base: str = "base", tuned: str = "tuned") -> DataFrame:
    """(metric, base, tuned, improvement) as shares, one row per metric."""
    def of(model: str, column: str) -> Column:
        return F.max(F.when(F.col("model") == model, F.col(column)))

    one = scores.agg(*[
        of(model, column).alias(f"{side}_{i}")
        for i, column in enumerate(METRICS.values()) for side, model in (("b", base), ("t", tuned))
    ])
    rows = F.array(*[
        F.struct(F.lit(name).alias("metric"), F.col(f"b_{i}").alias("base"), F.col(f"t_{i}").alias("tuned"),
                 (F.col(f"t_{i}") - F.col(f"b_{i}")).alias("improvement"))
        for i, name in enumerate(METRICS)
    ])
    return one.select(F.explode(rows).alias("r")).select("r.*")


def eval_gates(compared: DataFrame, least_tuned: float = 0.60, most_base: float = 0.50) -> DataFrame:
    """(gate, passed) on function-name accuracy; a run that fails a gate is a concern."""
    names = compared.filter(F.col("metric") == "Function name")
    gates = F.array(
        F.struct(F.lit("tuned beats base").alias("gate"), (F.col("tuned") > F.col("base")).alias("passed")),
        F.struct(F.lit(f"tuned reaches {least_tuned:.2f}").alias("gate"), (F.col("tuned") >= least_tuned).alias("passed")),
        F.struct(F.lit(f"base stays within {most_base:.2f}").alias("gate"), (F.col("base") <= most_base).alias("passed")),
    )
    return names.select(F.explode(gates).alias("g")).select("g.*")


def side_by_side(judged: DataFrame, models: list[str]) -> DataFrame:
    """(example_id, name, one verdict column per model)."""
    return judged.groupBy("example_id", "name").pivot("model", models).agg(F.first("verdict"))


def _report(rows: DataFrame, checks: dict[str, Column]) -> DataFrame:
    one = rows.agg(F.count("*").alias("rows"), *[
        F.count(F.when(~F.coalesce(ok, F.lit(False)), 1)).alias(f"c{i}") for i, ok in enumerate(checks.values())
    ])
    listed = F.array(*[
        F.struct(F.lit(name).alias("check"), F.col("rows"), F.col(f"c{i}").alias("bad")) for i, name in enumerate(checks)
    ])
    return one.select(F.explode(listed).alias("r")).select("r.*")


def check_training(rows: DataFrame) -> DataFrame:
    """(check, rows, bad) over training examples, all checks in one pass. Each is named by its rule."""
    m = F.col("messages")
    call = F.get(F.get(m, F.lit(1))["tool_calls"], F.lit(0))["function"]
    return _report(rows, {
        "messages and tools present": m.isNotNull() & F.col("tools").isNotNull(),
        "user turn first": F.get(m, F.lit(0))["role"] == "user",
        "assistant turn has tool calls": (F.get(m, F.lit(1))["role"] == "assistant")
        & F.get(m, F.lit(1))["tool_calls"].isNotNull(),
        "exactly one call": F.size(F.get(m, F.lit(1))["tool_calls"]) == 1,
        "call has name and arguments": call["name"].isNotNull() & call["arguments"].isNotNull(),
        "tools are function specs": F.forall("tools", lambda t: (t["type"] == "function") & t["function"].isNotNull()),
        "types are JSON Schema types": F.forall("tools", lambda t: F.forall(
            F.map_values(t["function"]["parameters"]["properties"]), lambda p: p["type"].isin(SIX_TYPES))),
    })


def check_raw(raw: DataFrame, problems: list[str]) -> DataFrame:
    """(check, rows, bad) over raw rows: how many cannot be read, and why."""
    rows = with_problems(raw)
    return _report(rows, {p: F.coalesce(F.col("problem") != p, F.lit(True)) for p in problems})


def check_evaluation(rows: DataFrame) -> DataFrame:
    """(check, rows, bad) over evaluation examples."""
    return _report(rows, {
        "truth is outside messages": F.forall("messages", lambda m: m["role"] != "assistant"),
        "tool calls filled": F.size("tool_calls") == 1,
        "no tool is too wide": F.forall(
            "tools", lambda t: F.size(F.map_keys(t["function"]["parameters"]["properties"])) <= WIDEST_TOOL),
    })


def own_models(listed: DataFrame, namespace: str, expected: list[str] = ()) -> DataFrame:
    """Model ids that contain the namespace; an expected id that is not served is an error."""
    if expected:
        served = {r[0] for r in listed.filter(F.col("model_id").isin(list(expected))).distinct().collect()}
        missing = sorted(set(expected) - served)
        if missing:
            raise LookupError(f"models not served yet: {missing}")
    return listed.filter(F.contains("model_id", F.lit(namespace)))


def with_responses(calls: DataFrame, responses: DataFrame, order: str = "part") -> DataFrame:
    """(turn, call, name, response): each call with the response of its name, call order kept.

    If a turn calls a function twice, its first call gets the first response, and so on; ``order`` is the column that
    tells the order of responses.
    """
    def nth(by: str) -> Column:
        return F.row_number().over(W.partitionBy("turn", "name").orderBy(by))

    told = responses.select("turn", "name", "response", nth(order).alias("_nth"))
    return calls.withColumn("_nth", nth("call")).join(told, ["turn", "name", "_nth"], "left").drop("_nth")


def call_log(history: DataFrame) -> DataFrame:
    """(conv_id, turn, part, role, kind, payload) for every part of a function-calling history."""
    from millrace.functions.toolschema import call_text
    p = F.col("p")
    kind = (
        F.when(p["function_call"].isNotNull(), "call").when(p["function_response"].isNotNull(), "response").otherwise("text")
    )
    payload = (
        F.when(kind == "call", call_text(p["function_call"]["name"], p["function_call"]["args"]))
        .when(kind == "response", F.concat(p["function_response"]["name"], F.lit(" -> "), p["function_response"]["response"]))
        .otherwise(p["text"])
    )
    parts = history.select("conv_id", "turn", "role", F.posexplode("parts").alias("part", "p"))
    return parts.select("conv_id", "turn", F.col("part").cast("bigint").alias("part"), "role", kind.alias("kind"), payload.alias("payload"))

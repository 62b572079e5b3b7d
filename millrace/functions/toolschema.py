"""Loose tool descriptions to JSON Schema, as column expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Loose type name -> JSON Schema type.
JSON_TYPES = {
    "str": "string", "string": "string",
    "int": "integer", "integer": "integer",
    "float": "number", "number": "number",
    "bool": "boolean", "boolean": "boolean",
    "dict": "object", "Dict": "object", "object": "object",
    "list": "array", "List": "array", "array": "array",
}
SIX_TYPES = ["string", "integer", "number", "boolean", "object", "array"]

RAW_TOOLS = (
    "array<struct<name string, description string, "
    "parameters map<string, struct<type string, description string, `default` variant>>>>"
)
RAW_ANSWERS = "array<struct<name string, arguments variant>>"


def json_type(loose: Column) -> Column:
    """The JSON Schema type of a loose type text; what is not known becomes ``string``."""
    name = F.btrim(loose)
    with_default = F.contains(name, F.lit(",")) & F.contains(name, F.lit("default"))
    name = F.when(with_default, F.btrim(F.split_part(name, F.lit(","), F.lit(1)))).otherwise(name)
    bare = F.btrim(F.replace(name, F.lit(", optional"), F.lit("")))
    container = bare.startswith("Tuple") | bare.startswith("List[") | bare.startswith("Set") | (bare == "set")
    known = F.coalesce(*[F.when(bare.isin([k for k, v in JSON_TYPES.items() if v == t]), t) for t in SIX_TYPES])
    return (
        F.when(name.startswith("default="), "string")
        .when(bare.startswith("Callable"), "string")
        .when(container, "array")
        .otherwise(F.coalesce(known, F.lit("string")))
    )


def has_default(info: Column) -> Column:
    """A default counts unless it is absent, null or the empty text."""
    value = info["default"]
    text = F.try_variant_get(value, "$", "string")
    return value.isNotNull() & ~F.coalesce(F.is_variant_null(value), F.lit(True)) & (F.coalesce(text, F.lit("-")) != "")


def _property(info: Column) -> Column:
    return F.struct(
        json_type(F.coalesce(info["type"], F.lit("str"))).alias("type"),
        F.coalesce(info["description"], F.lit("")).alias("description"),
        F.when(has_default(info), info["default"]).alias("default"),
    )


def function_specs(tools: Column) -> Column:
    """Parsed tools as an array of function specifications."""
    def spec(tool: Column) -> Column:
        given = F.coalesce(tool["parameters"], F.from_json(F.lit("{}"), "map<string, struct<type string, description string, `default` variant>>"))
        return F.struct(
            F.lit("function").alias("type"),
            F.struct(
                tool["name"].alias("name"),
                F.coalesce(tool["description"], F.lit("")).alias("description"),
                F.struct(
                    F.lit("object").alias("type"),
                    F.transform_values(given, lambda _, info: _property(info)).alias("properties"),
                    F.map_keys(F.map_filter(given, lambda _, info: ~has_default(info))).alias("required"),
                ).alias("parameters"),
            ).alias("function"),
        )
    return F.transform(tools, spec)


def same_json(left: Column, right: Column) -> Column:
    """Equal values whatever the key order; 1 equals 1.0 but not "1"."""
    def canon(text: Column) -> Column:
        return F.to_json(F.try_parse_json(text))
    return F.coalesce(canon(left) == canon(right), F.lit(False))


def call_text(name: Column, arguments: Column) -> Column:
    """``name(k=v, k=v)`` from a map of arguments."""
    pairs = F.transform(F.map_entries(arguments), lambda e: F.concat(e["key"], F.lit("="), F.coalesce(e["value"], F.lit("None"))))
    return F.concat(name, F.lit("("), F.array_join(pairs, ", "), F.lit(")"))

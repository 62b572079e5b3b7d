"""Prompts, sections, snippets and small parsers, as column expressions."""

from __future__ import annotations

import re
from collections.abc import Mapping

from pyspark.sql import Column, functions as F

BLANKS = " \t\r\n"
_FIELD = re.compile(r"\{\{\s*(\w+)\s*\}\}|\{(\w+)\}")


def render(template: str, values: Mapping[str, Column]) -> Column:
    """A template with ``{name}`` or ``{{name}}`` filled from columns.

    The template is cut at its fields once, so a value that itself holds braces stays as it is.
    """
    pieces, at = [], 0
    for field in _FIELD.finditer(template):
        name = field.group(1) or field.group(2)
        if name not in values:
            raise KeyError(f"no value for template field {name!r}")
        pieces += [F.lit(template[at:field.start()]), values[name].cast("string")]
        at = field.end()
    pieces.append(F.lit(template[at:]))
    return F.concat(*[F.coalesce(p, F.lit("")) for p in pieces])


def instruct(prompt: Column) -> Column:
    return F.concat(F.lit("<s>[INST] "), prompt, F.lit(" [/INST]"))


def messages(system: Column, user: Column) -> Column:
    """[system, user] as an array of (role, content)."""
    def message(role: str, content: Column) -> Column:
        return F.struct(F.lit(role).alias("role"), content.alias("content"))
    return F.array(message("system", system), message("user", user))


def multimodal(text: Column, uris: Column) -> Column:
    """One text part followed by one part per image, in order."""
    def part(kind: str, body: Column, address: Column) -> Column:
        return F.struct(F.lit(kind).alias("type"), body.alias("text"), address.alias("image_url"))
    none = F.lit(None).cast("string")
    return F.concat(F.array(part("text", text, none)), F.transform(uris, lambda u: part("image_url", none, u)))


def truncated(text: Column, n: int) -> Column:
    return F.substring(text, 1, n)


def snippet(text: Column, n: int = 500) -> Column:
    """The first n characters, without outer blanks, and three dots."""
    return F.concat(F.btrim(truncated(text, n), F.lit(BLANKS)), F.lit("..."))


# Fixed value: the answer that stands for an empty section.
NOTHING_FOUND = "No relevant information found!"


def section(text: Column, tag: str) -> Column:
    """What stands between <tag> and </tag>; a fixed sentence if that is nothing."""
    inner = F.btrim(F.regexp_extract(text, f"(?s)<{tag}>(.*?)</{tag}>", 1), F.lit(BLANKS))
    return F.coalesce(F.nullif(inner, F.lit("")), F.lit(NOTHING_FOUND))


def purchases_total(activity: Column) -> Column:
    """Sum of all dollar amounts in an account activity line."""
    amounts = F.regexp_extract_all(activity, F.lit(r"\$([0-9,]*[0-9])"), F.lit(1))
    return F.aggregate(
        amounts, F.lit(0).cast("bigint"), lambda s, a: s + F.replace(a, F.lit(","), F.lit("")).cast("bigint")
    )


def inquiries(activity: Column) -> Column:
    return F.regexp_extract(activity, r"Inquiries: ([0-9]+)", 1).cast("bigint")


def priority(activity: Column, least_total: int = 50_000, least_inquiries: int = 2) -> Column:
    """High purchases and recent interest together make an account worth a follow-up."""
    return (purchases_total(activity) >= least_total) & (inquiries(activity) >= least_inquiries)


def on_topic(classification: Column, guard: Column) -> Column:
    """A guard's verdict; without a guard prompt everything is on topic."""
    said = F.contains(F.lower(F.btrim(classification, F.lit(BLANKS))), F.lit("on-topic"))
    no_guard = guard.isNull() | (guard == "")
    return F.when(no_guard, True).otherwise(F.coalesce(said, F.lit(False)))


def sentiment(words: Column, positive: list[str], negative: list[str]) -> Column:
    """positive, neutral or negative by the sign of (good words - bad words)."""
    good = F.size(F.filter(words, lambda w: w.isin(*positive)))
    bad = F.size(F.filter(words, lambda w: w.isin(*negative)))
    return F.when(good > bad, "positive").when(good < bad, "negative").otherwise("neutral")


CODE_BLOCK = "(?s)```([A-Za-z0-9_+-]*)\\n(.*?)```"


def code_blocks(text: Column) -> Column:
    """Fenced blocks of a message as (language, code), in order."""
    return F.arrays_zip(
        F.regexp_extract_all(text, F.lit(CODE_BLOCK), F.lit(1)).alias("language"),
        F.regexp_extract_all(text, F.lit(CODE_BLOCK), F.lit(2)).alias("code"),
    )


# The dimensions a critique scores.
CRITIQUE = ["bugs", "transformation", "compliance", "type", "encoding", "aesthetics"]


def critique_scores(text: Column) -> dict[str, Column]:
    return {k: F.regexp_extract(text, rf"\b{k}: *([0-9]+)", 1).try_cast("int") for k in CRITIQUE}


def critique_valid(scores: Mapping[str, Column], has_bug: Column) -> Column:
    """All scores are within 1-10, and a known bug keeps the bug score under 5."""
    inside = F.lit(True)
    for value in scores.values():
        inside = inside & F.coalesce(value.between(1, 10), F.lit(False))
    return inside & (~has_bug | (scores["bugs"] < 5))

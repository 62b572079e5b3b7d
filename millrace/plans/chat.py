"""Conversation histories and limits."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.operators import chat as C
from millrace.plans.registry import query
from millrace.session import load
from millrace.sources.staging import stage


# Messages in a block that histories share; the conversations here are short.
BLOCK = 4


@query("hist_prior_turns", f"""
with p as (
  select conv_id, turn, role, count(*) over w as prior_messages, coalesce(sum(length(text)) over w, 0)::bigint as prior_chars,
         count(*) filter (where role = 'user') over w as prior_user
  from conversations window w as (partition by conv_id order by turn rows between unbounded preceding and 1 preceding))
select *, prior_messages // {BLOCK} as prefix_blocks, prior_messages % {BLOCK} as tail_messages from p""")
def hist_prior_turns(spark, d):
    """What is sent along with each message: its extent, and as blocks shared with the later ones and a tail."""
    before = C.prior_turns(load(spark, d, "conversations")).drop("text")
    return before.withColumns({"prefix_blocks": F.floor(F.col("prior_messages") / BLOCK), "tail_messages": F.col("prior_messages") % BLOCK})


@query("hist_messages", """
select a.conv_id, a.turn as ask_turn, m.turn, m.role, m.text from conversations a join conversations m
  on a.conv_id = m.conv_id and m.turn < a.turn where a.role = 'user'""")
def hist_messages(spark, d):
    """The histories of all questions, kept as shared blocks and a tail, and written out at the end."""
    numbered = C.placed(load(spark, d, "conversations"), BLOCK)
    referred = stage(C.histories(numbered, F.col("role") == "user"), "histories")
    return C.expanded(numbered, referred).drop("place")


@query("hist_max_turns", """
select conv_id, turn, role from (select *, sum((role = 'user')::int) over (partition by conv_id order by turn) as x,
  row_number() over (partition by conv_id order by turn) as rn from conversations) where rn <= 8 and x <= 2""")
def hist_max_turns(spark, d):
    short = C.first_turns(load(spark, d, "conversations"), 8)
    return C.exchanges(short, 2).select("conv_id", "turn", "role")


@query("hist_last_n", """
select conv_id, turn, count(*) over w as looked_at,
       coalesce(array_to_string(list(concat(role, ': ', text)) over w, chr(10)), '') as last_text
from conversations window w as (partition by conv_id order by turn rows between 3 preceding and 1 preceding)""")
def hist_last_n(spark, d):
    return C.last_messages(load(spark, d, "conversations"), 3)


# A long assistant message ends the talk; replies of uneven length count as automatic.
_MARKED = "case when role = 'assistant' and length(text) > 500 then concat(text, ' TERMINATE') else text end"


@query("hist_until_terminate", f"""
with m as (select conv_id, turn, role, {_MARKED} as text from conversations),
p as (select *, length(text) % 4 <> 0 as auto, row_number() over (partition by conv_id order by turn) as place from m),
b as (select *, max(case when not auto then place end) over (partition by conv_id order by turn) as brk from p),
f as (select *, case when auto and place - coalesce(brk, 0) > 3 then turn end as over_turn,
             case when contains(text, 'TERMINATE') then turn end as marked_turn from b),
e as (select conv_id, min(over_turn) as over_turn, min(marked_turn) as marked_turn from f group by 1)
select f.conv_id, turn, role from f join e using (conv_id)
where turn < coalesce(e.over_turn, 1000000) and turn <= coalesce(e.marked_turn, 1000000)""")
def hist_until_terminate(spark, d):
    messages = load(spark, d, "conversations").withColumn("text", F.expr(_MARKED))
    return C.until_terminate(messages, F.length("text") % 4 != 0).select("conv_id", "turn", "role")

"""Chat formatting: a state machine over roles and a declarative template.

A template states how a turn is marked, which roles may follow which, and which
roles' texts carry loss. The operator walks the machine over the roles of each
conversation (``valid``: every step is allowed and the last state may end) and
emits the output as text segments with a loss flag each; their texts joined are
``formatted``. Control strings inside texts and roles are escaped reversibly: a
backslash is doubled, and a control string gets a backslash after its first
character. A single backslash occurs in no other way, so one replacement
undoes it.

Only DataFrame functions are used. One row holds one conversation, as the
output asks for; rows meet in one shuffle by conversation.

Defined results: null text or role reads as empty; turns are ordered by (turn,
role, text), nulls first, so ties have one order; repeated rows are turns of
their own; rows of a null conversation id form one conversation; an invalid
conversation is formatted too, with ``valid`` false; very long texts and conversations are formatted whole, in
one row; other columns, also of clashing names, are ignored; an empty table gives no rows.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventlens.llm.common import table


@dataclass(frozen=True)
class Template:
    """Marks of a turn, control strings to escape, and the machine over roles."""

    begin: str = "<|im_start|>"
    after_role: str = "<|im_sep|>"
    end: str = "<|im_end|>"
    controls: tuple[str, ...] = ("<|im_start|>", "<|im_sep|>", "<|im_end|>", "<|endoftext|>", "<s>", "</s>", "[INST]", "[/INST]",
                                 "<<SYS>>", "<</SYS>>")
    loss_roles: tuple[str, ...] = ("assistant",)
    #: state -> roles that may come next; a role is the next state.
    moves: tuple[tuple[str, tuple[str, ...]], ...] = (
        ("start", ("system", "user")), ("system", ("user",)), ("user", ("assistant",)), ("assistant", ("user",)))
    final: tuple[str, ...] = ("assistant",)


CHAT = Template()


def escape(text: Column, template: Template = CHAT) -> Column:
    out = F.replace(text, F.lit("\\"), F.lit("\\\\"))
    for c in template.controls:
        out = F.replace(out, F.lit(c), F.lit(f"{c[0]}\\{c[1:]}"))
    return out


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"\\(\\?)", "$1")


def format_chats(rows: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text",
                 template: Template = CHAT) -> DataFrame:
    """Per conversation: id, ``segments`` (array of text and loss), ``formatted``, ``valid``."""
    empty = F.lit("")
    one = F.struct(F.col(turn).alias("turn"), F.coalesce(F.col(role), empty).alias("role"), F.coalesce(F.col(text), empty).alias("text"))
    chats = rows.groupBy(F.col(conv).alias("conv")).agg(F.sort_array(F.collect_list(one)).alias("turns"))
    allowed = F.array(*(F.lit(f"{state}\n{r}") for state, roles in template.moves for r in roles))

    def step(state: Column, t: Column) -> Column:
        return F.when(F.array_contains(allowed, F.concat(state, F.lit("\n"), t.role)), t.role).otherwise(F.lit("\nno state"))

    def segments(t: Column) -> Column:
        seg = lambda x, loss: F.struct(x.alias("text"), loss.alias("loss"))
        return F.array(seg(F.concat(F.lit(template.begin), escape(t.role, template), F.lit(template.after_role)), F.lit(False)),
                       seg(escape(t.text, template), t.role.isin(*template.loss_roles)), seg(F.lit(template.end), F.lit(False)))

    chats = chats.select(
        "conv", F.aggregate("turns", F.lit("start"), step).isin(*template.final).alias("valid"),
        F.flatten(F.transform("turns", segments)).alias("segments"))
    return chats.select(F.col("conv").alias(conv), "segments", F.array_join(F.col("segments.text"), "").alias("formatted"), "valid")


def read_turns(formatted: Column, template: Template = CHAT) -> Column:
    """Turns (role, text) read back from the formatted text."""
    parts = F.split(formatted, _literal(template.end))
    bodies = F.slice(parts, F.lit(1), F.size(parts) - 1)

    def turn(body: Column) -> Column:
        at = F.split(F.substr(body, F.lit(len(template.begin) + 1)), _literal(template.after_role))
        return F.struct(unescape(at[0]).alias("role"), unescape(at[1]).alias("text"))

    return F.transform(bodies, turn)


def read_loss(segments: Column) -> Column:
    """All text under the loss mask, unescaped."""
    return F.array_join(F.transform(F.filter(segments, lambda s: s.loss), lambda s: unescape(s.text)), "")


def _literal(s: str) -> str:
    return "\\Q" + s + "\\E"


#: A conversation that holds control strings on both sides.
PROBE = [(-7, 0, "user", "</s>[INST] ok [/INST]"), (-7, 1, "assistant", "</s>[INST] ok [/INST]")]


def op9_chat_format(spark, sf_dir) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    probe = spark.range(2).select(F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"),
                                  F.when(F.col("id") == 0, PROBE[0][2]).otherwise(PROBE[1][2]).alias("role"), F.lit(PROBE[0][3]).alias("text"))
    chats = format_chats(rows.unionByName(probe))
    turns, loss = read_turns(F.col("formatted")), read_loss(F.col("segments"))
    out = chats.select("conv_id", "valid", "formatted", turns.alias("turns"), loss.alias("loss"))
    nl = F.lit("\n")
    joined = F.array_join(F.transform("turns", lambda t: F.concat(t.role, nl, t.text, nl)), "")
    return out.select("conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(joined, 256).alias("turns_sha256"),
                      F.char_length("loss").cast("long").alias("loss_chars"), F.sha2("loss", 256).alias("loss_sha256"),
                      F.char_length("formatted").cast("long").alias("formatted_chars"), "valid")


def _sql_escape(x: str) -> str:
    out = f"replace({x}, '\\', '\\\\')"
    for c in CHAT.controls:
        out = f"replace({out}, '{c}', '{c[0]}\\{c[1:]}')"
    return out


_PAIRS = ", ".join(f"'{state}>{r}'" for state, roles in CHAT.moves for r in roles)
OP9_SQL = f"""
WITH rows AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL VALUES (-7, 0, 'user', '</s>[INST] ok [/INST]'), (-7, 1, 'assistant', '</s>[INST] ok [/INST]')),
steps AS (
  SELECT *, lag(role, 1, 'start') OVER w || '>' || role AS step, row_number() OVER w AS k,
         count(*) OVER (PARTITION BY conv_id) AS n
  FROM rows WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text))
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY k)) AS turns_sha256,
  CAST(sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END) AS BIGINT) AS loss_chars,
  sha256(string_agg(CASE WHEN role = 'assistant' THEN text ELSE '' END, '' ORDER BY k)) AS loss_sha256,
  CAST(sum(length({_sql_escape('role')}) + length({_sql_escape('text')}) + {len(CHAT.begin + CHAT.after_role + CHAT.end)}) AS BIGINT)
    AS formatted_chars,
  bool_and(step IN ({_PAIRS}) AND (k < n OR role = 'assistant')) AS valid
FROM steps GROUP BY conv_id
"""

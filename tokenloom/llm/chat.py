"""Chat formatting: schema fingerprints select declarative mappings to turns.

``fingerprint`` hashes the nested field paths of a frame that any layout knows;
``LAYOUTS`` maps fingerprints to declarative mappings (which path is a turn's
role or text, or which fixed role a path has). ``canonical_turns`` brings every
layout to (conv_id, turns: array of (role, text)); ``format_turns`` writes the
template and the loss mask; ``parse_formatted`` and ``loss_text`` read them back.

Template, per turn: ``[INST]role[/INST]text</s>``. Inside roles and texts a
backslash is put after the first character of each control string (``<s>``,
``</s>``, ``[INST]``, ``[/INST]``), and one more where such backslashes already
stand there, so control strings never occur inside a text, unescaping is
exact, and text without control strings is unchanged.

The mask is a list of pieces (piece, loss): the formatted string is the pieces
joined, and the loss falls on the pieces that are an assistant's text.

Defined results: null role or text is empty; rows of one conversation are
ordered by turn, then role, then text, so ties and repeated rows keep a fixed
order; rows with null conv_id form one conversation; an empty table gives an
empty result; other columns do not matter, those of other layouts included (see ``_fitting``). A conversation is one
row of the result, so its turns meet in one task: its length is the only bound.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from tokenloom.llm.common import table

ESCAPE_IN = r"([<\[])(\\*)(?=/?s>|/?INST\])"
ESCAPE_OUT = r"([<\[])\\(\\*)(?=/?s>|/?INST\])"
LOSS_ROLE = "assistant"
TURN = "struct<role:string,text:string>"


@dataclass(frozen=True)
class Layout:
    """How a layout's paths make turns.

    ``rows``: one row per turn (order, role, text paths). ``items``: an array of
    turns (array path, role field, text field, {role name: canonical role}).
    ``fields``: fixed roles, as (role, path); a null field makes no turn.
    """

    name: str
    rows: tuple[str, str, str] | None = None
    items: tuple[str, str, str] | None = None
    fields: tuple[tuple[str, str], ...] = ()
    roles: tuple[tuple[str, str], ...] = ()

    @property
    def paths(self) -> tuple[str, ...]:
        if self.rows:
            return self.rows
        if self.items:
            a, r, t = self.items
            return (a, f"{a}[].{r}", f"{a}[].{t}")
        return tuple(p for _, p in self.fields)


LAYOUT_LIST = (
    Layout("turn_rows", rows=("turn", "role", "text")),
    Layout("messages", items=("messages", "role", "content")),
    Layout("from_value", items=("conversations", "from", "value"),
           roles=(("human", "user"), ("gpt", "assistant"))),
    Layout("prompt_completion", fields=(("user", "prompt"), ("assistant", "completion"))),
    Layout("prompt_response", fields=(("system", "system"), ("user", "prompt"), ("assistant", "response"))),
    Layout("instruction", fields=(("user", "instruction"), ("user", "input"), ("assistant", "output"))),
    Layout("instruction_short", fields=(("user", "instruction"), ("assistant", "output"))),
)

KNOWN_PATHS = frozenset(p for layout in LAYOUT_LIST for p in layout.paths)


def field_paths(dtype: T.DataType, at: str = "") -> list[str]:
    """All nested field paths; array elements are written ``[]``."""
    if isinstance(dtype, T.StructType):
        out = []
        for f in dtype.fields:
            p = f"{at}.{f.name}" if at else f.name
            out += [p, *field_paths(f.dataType, p)]
        return out
    if isinstance(dtype, T.ArrayType):
        return field_paths(dtype.elementType, f"{at}[]")
    return []


def hash_paths(paths) -> str:
    return hashlib.sha256("\n".join(sorted(set(paths) & KNOWN_PATHS)).encode()).hexdigest()


def fingerprint(schema: T.StructType) -> str:
    """Hash of the schema's field paths that some layout uses."""
    return hash_paths(field_paths(schema))


LAYOUTS = {hash_paths(layout.paths): layout for layout in LAYOUT_LIST}


def _fitting(schema: T.StructType) -> Layout | None:
    """The layout of a schema that has paths of several: of those whose paths are all there, one row per
    turn comes before an array of turns and this before fixed fields; then more paths, then the order of LAYOUT_LIST."""
    present = set(field_paths(schema))
    fits = [x for x in LAYOUT_LIST if set(x.paths) <= present]
    return min(fits, key=lambda x: (x.rows is None, x.items is None, -len(x.paths)), default=None)


def _turn(role: Column, text: Column) -> Column:
    return F.struct(F.coalesce(role.cast("string"), F.lit("")).alias("role"),
                    F.coalesce(text.cast("string"), F.lit("")).alias("text"))


def canonical_turns(df: DataFrame, conv_id: str = "conv_id", layout: Layout | None = None) -> DataFrame:
    """(conv_id, turns) of a frame in any known layout."""
    layout = layout or LAYOUTS.get(fingerprint(df.schema)) or _fitting(df.schema)
    if layout is None:
        raise ValueError(f"no layout for the paths {sorted(set(field_paths(df.schema)) & KNOWN_PATHS)}")
    if layout.rows:
        order, role, text = (F.col(p) for p in layout.rows)
        item = F.struct(order.alias("o"), _turn(role, text).alias("t"))
        return (df.select(F.col(conv_id).alias("conv_id"), item.alias("i")).groupBy("conv_id")
                .agg(F.sort_array(F.collect_list("i")).alias("l"))
                .select("conv_id", F.transform("l", lambda x: x["t"]).alias("turns")))
    if layout.items:
        path, r, t = layout.items

        def turn(x: Column) -> Column:
            role = x[r].cast("string")
            for old, new in layout.roles:
                role = F.when(x[r] == old, F.lit(new)).otherwise(role)
            return _turn(role, x[t])

        turns = F.transform(F.coalesce(F.col(path), F.array().cast(df.schema[path].dataType)), turn)
    else:
        turns = F.filter(F.array(*[F.when(F.col(p).isNotNull(), _turn(F.lit(role), F.col(p)))
                                   for role, p in layout.fields]), lambda x: x.isNotNull())
    return df.select(F.col(conv_id).alias("conv_id"), turns.cast(f"array<{TURN}>").alias("turns"))


def escape(text: Column) -> Column:
    return F.regexp_replace(text, ESCAPE_IN, r"$1\\$2")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, ESCAPE_OUT, "$1$2")


def format_turns(convs: DataFrame) -> DataFrame:
    """(conv_id, turns) -> (conv_id, formatted, pieces array<struct<piece, loss>>)."""
    def pieces(t: Column) -> Column:
        return F.array(
            F.struct(F.concat(F.lit("[INST]"), escape(t["role"]), F.lit("[/INST]")).alias("piece"), F.lit(False).alias("loss")),
            F.struct(escape(t["text"]).alias("piece"), (t["role"] == LOSS_ROLE).alias("loss")),
            F.struct(F.lit("</s>").alias("piece"), F.lit(False).alias("loss")))

    cut = convs.select("conv_id", F.flatten(F.transform("turns", pieces)).alias("pieces"))
    return cut.select("conv_id", F.array_join(F.transform("pieces", lambda p: p["piece"]), "").alias("formatted"), "pieces")


def parse_formatted(formatted: Column) -> Column:
    """The turns of a formatted conversation, unescaped."""
    parts = F.split(formatted, "</s>", -1)
    return F.transform(
        F.slice(parts, F.lit(1), F.size(parts) - 1),
        lambda p: F.struct(
            unescape(F.regexp_extract(p, r"(?s)\A\[INST\](.*?)\[/INST\]", 1)).alias("role"),
            unescape(F.regexp_extract(p, r"(?s)\A\[INST\].*?\[/INST\](.*)\z", 1)).alias("text")))


def loss_text(pieces: Column) -> Column:
    """All text under the loss mask, unescaped."""
    return F.array_join(F.transform(F.filter(pieces, lambda p: p["loss"]), lambda p: unescape(p["piece"])), "")


def op8_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    literal = "</s>[INST] ok [/INST]"
    planted = spark.range(1).select(
        F.lit(-1).cast("long").alias("conv_id"),
        F.array(*[F.struct(F.lit(r).alias("role"), F.lit(literal).alias("content")) for r in ("user", "assistant")])
        .alias("messages"))
    turns = canonical_turns(rows).unionByName(canonical_turns(planted))
    out = format_turns(turns)
    back = out.select("conv_id", "formatted", parse_formatted(F.col("formatted")).alias("turns"),
                      loss_text(F.col("pieces")).alias("loss"))
    told = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return back.select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"),
        F.sha2(told, 256).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"), F.sha2("loss", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"))


def oracle() -> str:
    esc = r"regexp_replace(regexp_replace({}, '([<\[])(\\*)(/?s>)', '\1\\\2\3', 'g'), '([<\[])(\\*)(/?INST\])', '\1\\\2\3', 'g')"
    return f"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL VALUES (-1, 0, 'user', '</s>[INST] ok [/INST]'), (-1, 1, 'assistant', '</s>[INST] ok [/INST]')),
f AS (
  SELECT *, 17 + length({esc.format('role')}) + length({esc.format('text')}) AS n FROM t),
g AS (
  SELECT conv_id, count(*) AS n_turns, sum(n) AS formatted_chars,
         string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text) AS told,
         coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '') AS loss
  FROM f GROUP BY conv_id)
SELECT conv_id, n_turns, sha256(told) AS turns_sha256, CAST(length(loss) AS BIGINT) AS loss_chars,
       sha256(loss) AS loss_sha256, CAST(formatted_chars AS BIGINT) AS formatted_chars
FROM g"""

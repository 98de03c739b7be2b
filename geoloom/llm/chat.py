"""Chat formatting with Spark expressions only.

Turns of a conversation are collected as structs, sorted, cut into blocks of one role by array
functions, and joined to one string. The template is

    <|im_start|>ROLE\\nTEXT[<|im_sep|>TEXT...]<|im_end|>\\n ...

Texts and roles are escaped, so that no control string of the template can come from them, and
:func:`parse_chat` gives back every turn exactly.

Defined results for odd rows: a NULL text or role is the empty string; turns sort by
``(turn, role, text)`` with NULL turns first, so ties have one order; repeated rows are turns of
their own; NULL conversation ids form one conversation; an empty table gives no rows; columns other
than the four named ones are ignored, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

START, SEPARATOR, END = "<|im_start|>", "<|im_sep|>", "<|im_end|>"


def escape(text: Column) -> Column:
    """Replace ``\\``, ``<|`` and line ends so that neither a control string nor a bare header line end remains."""
    return F.replace(F.replace(text, F.lit("\\"), F.lit("\\b")), F.lit("<|"), F.lit("\\c"))


def escape_role(role: Column) -> Column:
    return F.replace(escape(role), F.lit("\n"), F.lit("\\n"))


def unescape(text: Column) -> Column:
    """Inverse of :func:`escape` and :func:`escape_role`: every escape starts with a backslash, and bare ones are ``\\b``."""
    out = F.replace(text, F.lit("\\n"), F.lit("\n"))
    out = F.replace(out, F.lit("\\c"), F.lit("<|"))
    return F.replace(out, F.lit("\\b"), F.lit("\\"))


def format_chat(turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role",
                text: str = "text", trained_role: str = "assistant") -> DataFrame:
    """One row per conversation: ``conv, n_turns, n_blocks, formatted, spans``.

    ``spans`` is the loss mask: ``start`` (0-based) and ``length`` in code points of every (escaped)
    text of ``trained_role`` in ``formatted``; markers are never inside a span.
    """
    rows = turns.select(F.col(conv).alias("_conv"), F.col(turn).alias("_turn"),
                        F.coalesce(F.col(role), F.lit("")).alias("_role"),
                        F.coalesce(F.col(text), F.lit("")).alias("_text"))
    # Roles and texts are escaped before the sort decides ties, so ties are ordered by what is printed.
    packed = rows.groupBy("_conv").agg(F.sort_array(F.collect_list(F.struct(
        "_turn", escape_role(F.col("_role")).alias("role"),
        escape(F.col("_text")).alias("text"),
        (F.col("_role") == trained_role).alias("trained")))).alias("t"))
    heads = packed.withColumn("heads", F.expr(
        "filter(sequence(0, size(t) - 1), i -> i = 0 OR t[i].role <> t[i - 1].role)"))
    blocks = heads.withColumn("blocks", F.expr(
        "transform(heads, (h, k) -> slice(t, h + 1, IF(k + 1 < size(heads), heads[k + 1], size(t)) - h))"))
    # Segments in print order: markers are untrained, texts carry their turn's flag.
    segments = blocks.withColumn("segments", F.expr(f"""
        flatten(transform(blocks, b -> concat(
            flatten(transform(b, (x, j) -> array(
                named_struct('s', IF(j = 0, concat('{START}', x.role, '\\n'), '{SEPARATOR}'), 'trained', false),
                named_struct('s', x.text, 'trained', x.trained)))),
            array(named_struct('s', '{END}\\n', 'trained', false)))))"""))
    spans = F.expr("""
        aggregate(segments,
            named_struct('at', 0L, 'spans', CAST(array() AS ARRAY<STRUCT<start: BIGINT, length: BIGINT>>)),
            (a, x) -> named_struct('at', a.at + char_length(x.s), 'spans', IF(x.trained,
                array_append(a.spans, named_struct('start', a.at, 'length', CAST(char_length(x.s) AS BIGINT))), a.spans)),
            a -> a.spans)""")
    return segments.select(
        F.col("_conv").alias(conv), F.size("t").cast("bigint").alias("n_turns"),
        F.size("blocks").cast("bigint").alias("n_blocks"),
        F.array_join(F.expr("transform(segments, x -> x.s)"), "").alias("formatted"), spans.alias("spans"))


def parse_chat(formatted: Column) -> Column:
    """Turns ``array<struct<role, text>>`` read back from a formatted conversation."""
    blocks = F.filter(F.split(formatted, r"<\|im_end\|>\n"), lambda b: b != "")

    def turns(block: Column) -> Column:
        body = F.substring(block, F.lit(len(START) + 1), F.char_length(block))
        role = F.substring_index(body, "\n", 1)
        texts = F.split(F.substring(body, F.char_length(role) + 2, F.char_length(body)), r"<\|im_sep\|>")
        return F.transform(texts, lambda x: F.struct(unescape(role).alias("role"), unescape(x).alias("text")))

    return F.flatten(F.transform(blocks, turns))


def trained_text(formatted: Column, spans: Column) -> Column:
    """All text under the loss mask, unescaped and joined."""
    return F.array_join(F.transform(spans, lambda s: unescape(
        F.substring(formatted, (s["start"] + 1).cast("int"), s["length"].cast("int")))), "")

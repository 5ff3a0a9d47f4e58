"""Conversations from reply trees, formatted with turn marks and a loss mask.

A message names the message it replies to. Pointers to ancestors double their reach with each self-join, which gives
every message its depth and the sum of scores from the root; the leaf of the highest sum (ties to the smaller one) is
its tree's best branch, and joins over the same pointers collect the messages on it. One row per tree leaves the
joins, formatted in one task, since it is one text.

Texts cannot forge marks: all marks begin with ``<`` or ``[``, and in texts a backslash follows each of these; a
backslash of the text is doubled. Reading back undoes both. Rules: null texts and roles are empty; turns of equal number go
by role and text; repeated rows are turns of their own; a null conversation id is one conversation; messages whose
parent is missing are roots; an empty table gives no conversations.
"""

from __future__ import annotations

import re

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quillframe.llm.common import saved, sha

OPEN, CLOSE = "<|im_start|>", "<|im_end|>\n"
_ESCAPE = re.compile(r"[\\<\[]")
_UNESCAPE = re.compile(r"([<\[])\\|\\(\\|n)")
_TURN = re.compile(re.escape(OPEN) + r"(.*?)\n(.*?)" + re.escape(CLOSE), re.S)


def escaped(text: str) -> str:
    return _ESCAPE.sub(lambda m: "\\\\" if m[0] == "\\" else m[0] + "\\", text)


def unescaped(text: str) -> str:
    return _UNESCAPE.sub(lambda m: m[1] or ("\n" if m[2] == "n" else "\\"), text)


def formatted(turns: list[tuple[str, str]]) -> tuple[str, list[tuple[int, int]]]:
    """The text of a conversation and the spans of assistant texts in it, which are what a loss counts."""
    parts, spans, at = [], [], 0
    for role, text in turns:
        head, body = OPEN + escaped(role).replace("\n", "\\n") + "\n", escaped(text)
        if role == "assistant":
            spans.append((at + len(head), at + len(head) + len(body)))
        parts += [head, body, CLOSE]
        at += len(head) + len(body) + len(CLOSE)
    return "".join(parts), spans


def read_back(text: str) -> list[tuple[str, str]]:
    return [(unescaped(m[1]), unescaped(m[2])) for m in _TURN.finditer(text)]


def chains(conversations: DataFrame) -> DataFrame:
    """Rows by turn as reply trees: tree, node, parent, score, role, text; each turn replies to the one before it."""
    order = Window.partitionBy("tree").orderBy(F.col("turn").asc_nulls_last(), "role", "text")
    rows = conversations.select(F.col("conv_id").cast("bigint").alias("tree"), "turn", F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    return rows.withColumn("node", F.row_number().over(order).cast("bigint")).select(
        "tree", "node", F.expr("nullif(node - 1, 0)").alias("parent"), F.lit(0.0).alias("score"), "role", "text")


def best_paths(messages: DataFrame) -> DataFrame:
    """tree, node, depth of the messages on each tree's best root-to-leaf path."""
    same = F.col("a.tree").eqNullSafe(F.col("b.tree"))
    links = messages.select("tree", "node", "parent", "score")
    known = links.select("tree", "node")
    # A parent that is not there is no parent.
    reach = saved(links.alias("a").join(known.alias("b"), same & (F.col("a.parent") == F.col("b.node")), "left")
                  .select("a.tree", "a.node", F.col("b.node").alias("up"), F.col("a.score").alias("total"), F.lit(1).cast("bigint").alias("depth")))
    levels = [reach]
    while not levels[-1].where("up is not null").isEmpty():
        step = levels[-1].alias("a").join(levels[-1].alias("b"), same & (F.col("a.up") == F.col("b.node")), "left")
        levels.append(saved(step.select("a.tree", "a.node", F.col("b.up").alias("up"), (F.col("a.total") + F.coalesce("b.total", F.lit(0.0))).alias("total"),
                                        (F.col("a.depth") + F.coalesce("b.depth", F.lit(0))).alias("depth"))))
    parents = reach.where("up is not null").select("tree", F.col("up").alias("node")).distinct()
    leaves = levels[-1].alias("a").join(parents.alias("b"), same & (F.col("a.node") == F.col("b.node")), "left_anti")
    best = leaves.groupBy("tree").agg(F.max(F.struct("total", (-F.col("node")).alias("first"))).alias("m")).select("tree", (-F.col("m.first")).alias("node"))
    path = best
    for level in levels[:-1]:
        up = path.alias("a").join(level.alias("b"), same & (F.col("a.node") == F.col("b.node"))).where("b.up is not null").select("a.tree", F.col("b.up").alias("node"))
        path = saved(path.unionByName(up))
    return path.alias("a").join(levels[-1].alias("b"), same & (F.col("a.node") == F.col("b.node"))).select("a.tree", "a.node", "b.depth")


def conversations_of(messages: DataFrame) -> DataFrame:
    """conv_id, text, mask (spans of code points): one formatted conversation per tree."""
    messages = saved(messages)
    path = best_paths(messages).alias("b")
    turns = messages.alias("a").join(path, F.col("a.tree").eqNullSafe(F.col("b.tree")) & (F.col("a.node") == F.col("b.node"))).select("a.tree", "b.depth", "a.role", "a.text")
    rows = turns.groupBy("tree").agg(F.sort_array(F.collect_list(F.struct("depth", "role", "text"))).alias("turns"))
    schema = pa.schema([("conv_id", pa.int64()), ("text", pa.string()), ("mask", pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())])))])

    def run(batches):
        for batch in batches:
            done = [formatted([(t["role"], t["text"]) for t in turns]) for turns in batch.column("turns").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("tree"), pa.array([d[0] for d in done], pa.string()),
                                              pa.array([[{"start": a, "stop": b} for a, b in d[1]] for d in done], schema[2].type)], schema=schema)

    return rows.mapInArrow(run, "conv_id bigint, text string, mask array<struct<start bigint, stop bigint>>")


def digest(done: DataFrame) -> DataFrame:
    """What the formatted texts and masks hold, read back from them."""
    schema = pa.schema([("conv_id", pa.int64()), ("n_turns", pa.int64()), ("turns_sha256", pa.string()), ("loss_chars", pa.int64()), ("loss_sha256", pa.string()), ("formatted_chars", pa.int64())])

    def run(batches):
        for batch in batches:
            rows = []
            for conv, text, mask in zip(*(batch.column(n).to_pylist() for n in ("conv_id", "text", "mask"))):
                turns = read_back(text)
                loss = "".join(unescaped(text[m["start"]:m["stop"]]) for m in mask)
                rows.append((conv, len(turns), sha("".join(f"{r}\n{t}\n" for r, t in turns).encode()), len(loss), sha(loss.encode()), len(text)))
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], f.type) for i, f in enumerate(schema)], schema=schema)

    return done.mapInArrow(run, "conv_id bigint, n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, formatted_chars bigint")


def with_probe(conversations: DataFrame) -> DataFrame:
    """The table and conversation -1, whose turns are made of marks."""
    probe = conversations.sparkSession.sql("SELECT -1L AS conv_id, CAST(turn AS BIGINT) AS turn, role, '</s>[INST] ok [/INST]' AS text FROM VALUES (0, 'user'), (1, 'assistant') AS t(turn, role)")
    return conversations.select(F.col("conv_id").cast("bigint").alias("conv_id"), F.col("turn").cast("bigint").alias("turn"), "role", "text").unionByName(probe)


def oracle() -> str:
    """The same rows in DuckDB SQL."""
    escape = "replace(replace(replace({}, '\\', '\\\\'), '<', '<\\'), '[', '[\\')"
    marks = len(OPEN) + 1 + len(CLOSE)
    return f"""
    WITH rows AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
        UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]')
    SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
        CAST(sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END) AS BIGINT) AS loss_chars,
        sha256(coalesce(string_agg(CASE WHEN role = 'assistant' THEN text END, '' ORDER BY turn, role, text), '')) AS loss_sha256,
        CAST(sum({marks} + length({escape.format('role')}) + length({escape.format('text')})) AS BIGINT) AS formatted_chars
    FROM rows GROUP BY conv_id
    """

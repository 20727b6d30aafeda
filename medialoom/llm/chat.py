"""Reply trees as chat-formatted conversations.

Messages are rows (tree_id, msg_id, parent_id, role, text, score).  Root-to-leaf paths
come from iterative self-joins with doubling jumps: after k joins a message knows its
2^k-th ancestor, so a chain of depth d needs log2(d) rounds, not d.  Branches are ranked
by the mean score of their messages and each chosen path is formatted as one
conversation, with the spans of assistant text as its loss mask.

The template writes each turn as ``<s>[INST]role[/INST]text</s>``.  A control string
inside a role or text gets a backslash after its first character; one that already has
backslashes there gets one more, so taking one away restores every text.

Defined cases: null role or text reads as empty; a null score counts as 0; a parent
that is absent makes its message a root; of rows with the same (tree_id, msg_id) the
smallest (parent, role, text) counts; a null tree_id is a tree of its own; an empty
table gives an empty result.  Messages in a cycle have no root and raise ValueError.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window as W, functions as F, types as T

from medialoom.llm.common import batch_of, drop_path, materialise, table

#: Fixed values of the template.
BEGIN, HEAD, NECK, END = "<s>", "[INST]", "[/INST]", "</s>"
_INSIDE = r"(/?s>|/?INST\])"
ESCAPE = (r"([<\[])(\\*)" + _INSIDE, r"$1\\$2$3")
UNESCAPE = (re.compile(r"([<\[])\\(\\*)" + _INSIDE), r"\1\2\3")
TURN = re.compile(r"<s>\[INST\](.*?)\[/INST\](.*?)</s>", re.DOTALL)
MAX_ROUNDS = 40


def unescape(text: str) -> str:
    return UNESCAPE[0].sub(UNESCAPE[1], text)


def parse(formatted: str) -> list[tuple[str, str]]:
    """The (role, text) turns of a formatted conversation."""
    return [(unescape(r), unescape(t)) for r, t in TURN.findall(formatted)]


def tidy(messages: DataFrame) -> DataFrame:
    m = messages.select(
        F.col("tree_id").cast("long"),
        F.col("msg_id").cast("long"),
        F.col("parent_id").cast("long"),
        F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
        F.coalesce(F.col("score").cast("double"), F.lit(0.0)).alias("score"),
    )
    w = W.partitionBy("tree_id", "msg_id").orderBy("parent_id", "role", "text", "score")
    return m.withColumn("_n", F.row_number().over(w)).where("_n = 1").drop("_n")


def _on(left: DataFrame, a: str, right: DataFrame, b: str):
    return left["tree_id"].eqNullSafe(right["r_tree"]) & (left[a] == right[b])


def paths(messages: DataFrame) -> DataFrame:
    """(tree_id, leaf_id, msg_id, up): every message of every root-to-leaf path."""
    spark = messages.sparkSession
    nodes, _ = materialise(messages.select("tree_id", "msg_id", "parent_id"), "nodes")
    known = nodes.select(F.col("tree_id").alias("r_tree"), F.col("msg_id").alias("r_id"))
    step = nodes.where("parent_id IS NOT NULL")
    jump = step.join(known, _on(step, "parent_id", known, "r_id"), "left_semi").select("tree_id", "msg_id", F.col("parent_id").alias("up_id"))
    jumps = []
    jump, path = materialise(jump, "jump")
    while not jump.isEmpty():
        if len(jumps) == MAX_ROUNDS:
            raise ValueError("the messages hold a cycle")
        jumps.append(jump)
        far = jump.select(F.col("tree_id").alias("r_tree"), F.col("msg_id").alias("r_id"), F.col("up_id").alias("r_up"))
        jump, path = materialise(jump.join(far, _on(jump, "up_id", far, "r_id")).select("tree_id", "msg_id", F.col("r_up").alias("up_id")), "jump")
    drop_path(spark, path)
    parents = nodes.where("parent_id IS NOT NULL").select(F.col("tree_id").alias("r_tree"), F.col("parent_id").alias("r_id")).distinct()
    rows = nodes.join(parents, _on(nodes, "msg_id", parents, "r_id"), "left_anti").select("tree_id", F.col("msg_id").alias("leaf_id"), "msg_id", F.lit(0).cast("long").alias("up"))
    for k in reversed(range(len(jumps))):
        far = jumps[k].select(F.col("tree_id").alias("r_tree"), F.col("msg_id").alias("r_id"), F.col("up_id").alias("r_up"))
        both = F.expr(f"filter(array(struct(msg_id AS id, up AS up), struct(r_up AS id, up + {1 << k}L AS up)), x -> x.id IS NOT NULL)")
        rows = rows.join(far, _on(rows, "msg_id", far, "r_id"), "left").select("tree_id", "leaf_id", F.explode(both).alias("x")).select("tree_id", "leaf_id", F.col("x.id").alias("msg_id"), F.col("x.up").alias("up"))
    return rows


def format_trees(messages: DataFrame, best: int | None = None) -> DataFrame:
    """One row per chosen path: tree_id, leaf_id, path_rank, path_score, formatted, loss.

    ``best``: how many paths of a tree to format, by rank; None formats all.
    ``loss``: array of (start, end) code-point offsets into ``formatted``, end excluded.
    """
    m, _ = materialise(tidy(messages), "messages")
    p = paths(m)
    m2 = m.select(F.col("tree_id").alias("r_tree"), F.col("msg_id").alias("r_id"), "role", "text", "score")
    rows = p.join(m2, _on(p, "msg_id", m2, "r_id")).select("tree_id", "leaf_id", "up", "role", "text", "score")
    esc = lambda c: F.regexp_replace(c, *ESCAPE)
    head = F.concat(F.lit(BEGIN + HEAD), esc("role"), F.lit(NECK))
    rows = rows.select("tree_id", "leaf_id", "up", "score", (F.col("role") == "assistant").alias("is_loss"), head.alias("head"), esc("text").alias("body"))
    rows = rows.withColumn("turn", F.concat("head", "body", F.lit(END)))
    w = W.partitionBy("tree_id", "leaf_id").orderBy(F.desc("up"))
    rows = rows.withColumn("end", F.sum(F.length("turn").cast("long")).over(w.rowsBetween(W.unboundedPreceding, 0)))
    start = F.col("end") - F.length("turn") + F.length("head")
    rows = rows.withColumn("span", F.when(F.col("is_loss"), F.struct(start.alias("start"), (start + F.length("body")).alias("end"))))
    turns = F.sort_array(F.collect_list(F.struct((-F.col("up")).alias("at"), "turn", "span")))
    out = rows.groupBy("tree_id", "leaf_id").agg(turns.alias("t"), F.avg("score").alias("path_score"))
    out = out.withColumn("path_rank", F.row_number().over(W.partitionBy("tree_id").orderBy(F.desc("path_score"), "leaf_id")))
    if best is not None:
        out = out.where(F.col("path_rank") <= best)
    return out.select(
        "tree_id",
        "leaf_id",
        "path_rank",
        "path_score",
        F.expr("array_join(transform(t, x -> x.turn), '')").alias("formatted"),
        F.expr("transform(filter(t, x -> x.span IS NOT NULL), x -> x.span)").alias("loss"),
    )


def read_back(formatted: DataFrame) -> DataFrame:
    """Digests of what a formatted conversation says, from its string and mask alone."""
    schema = T.StructType.fromDDL("conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for tree, text, loss in zip(*(b.column(i).to_pylist() for i in range(3)), strict=True):
                turns = parse(text)
                said = hashlib.sha256()
                for role, body in turns:
                    said.update(f"{role}\n{body}\n".encode())
                masked = "".join(unescape(text[s["start"] : s["end"]]) for s in loss)
                yield batch_of(schema, conv_id=[tree], n_turns=[len(turns)], turns_sha256=[said.hexdigest()], loss_chars=[len(masked)], loss_sha256=[hashlib.sha256(masked.encode()).hexdigest()], formatted_chars=[len(text)])

    return formatted.select("tree_id", "formatted", "loss").mapInArrow(run, schema)


def op10(spark, sf_dir) -> DataFrame:
    c = table(spark, sf_dir, "conversations").select(F.col("conv_id").cast("long"), F.col("turn").cast("long"), F.col("role").cast("string"), F.col("text").cast("string"))
    extra = "</s>[INST] ok [/INST]"
    own = spark.createDataFrame([(-7, 0, "user", extra), (-7, 1, "assistant", extra)], c.schema)
    n = F.row_number().over(W.partitionBy("conv_id").orderBy("turn", F.coalesce("role", F.lit("")), F.coalesce("text", F.lit("")))).cast("long")
    m = c.unionByName(own).select(F.col("conv_id").alias("tree_id"), n.alias("msg_id"), "role", "text")
    m = m.withColumn("parent_id", F.when(F.col("msg_id") > 1, F.col("msg_id") - 1)).withColumn("score", F.length("text"))
    return read_back(format_trees(m))


_ESC = r"length(regexp_replace({0}, '([<\[])(\\*)(/?s>|/?INST\])', '\1\\\2\3', 'g'))"
ORACLE_SQL = rf"""
WITH c AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]')
SELECT CAST(conv_id AS BIGINT) AS conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(20 + {_ESC.format('role')} + {_ESC.format('text')}) AS BIGINT) AS formatted_chars
FROM c GROUP BY conv_id
"""

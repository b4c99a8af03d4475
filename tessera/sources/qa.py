"""Question/answer tables.

* :func:`qa_pairs`: each ``user`` turn of ``conversations`` with the next turn, if that is
  the ``assistant``'s.  Turns may have gaps.
* :func:`synthesize_qa`: word problems with known answers, one per ``lineitem`` row, using
  the five fixed templates; ``a`` and ``b`` are drawn from the row's keys into the fixed
  ranges.
* :func:`read_qa`: question/answer files.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tessera.functions import constants as K
from tessera.session import spread
from tessera.sources.tables import read_table

# A line item is identified by order, line number, part and supplier together (order and
# line number alone repeat in the given tables).
LINE_KEY_COLS = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]
LINE_KEY_SQL = "concat_ws('-', " + ", ".join(LINE_KEY_COLS) + ")"


def line_key():
    return F.concat_ws("-", *[F.col(c).cast("string") for c in LINE_KEY_COLS])


TURN_BLOCK = 1024
QA_SCHEMA = "question string, answer string"


def read_qa(spark: SparkSession, path: str, fmt: str = "json") -> DataFrame:
    """``(question, answer)`` rows of JSON-lines or Parquet files, explicit schema.  Folders
    ``split=train`` / ``split=test`` under ``path`` become a ``split`` column."""
    return spark.read.schema(QA_SCHEMA).format(fmt).load(path)


def with_next_turn(conv: DataFrame, block: int = TURN_BLOCK) -> DataFrame:
    """Adds ``next_role`` and ``next_text``: the conversation's next row by (turn, role, text).

    Rows are ordered within blocks of ``block`` turn numbers, and a block's last row takes
    the first row of the conversation's next block, so a very long conversation is spread
    over many tasks.  Rows without a conversation or turn have no place and are left out."""
    order = ["turn", "role", "text"]
    rows = conv.where("conv_id IS NOT NULL AND turn IS NOT NULL").withColumn("_block", F.floor(F.col("turn") / block))
    inside = F.lead(F.struct(*order)).over(Window.partitionBy("conv_id", "_block").orderBy(*order))
    heads = rows.groupBy("conv_id", "_block").agg(F.min(F.struct(*order)).alias("_head"))
    follows = heads.select("conv_id", "_block", F.lead("_head").over(
        Window.partitionBy("conv_id").orderBy("_block")).alias("_after"))
    joined = rows.withColumn("_inside", inside).join(follows, ["conv_id", "_block"])
    nxt = F.coalesce("_inside", "_after")
    return joined.select(*conv.columns, nxt["role"].alias("next_role"), nxt["text"].alias("next_text"))


def qa_pairs(spark: SparkSession, base: str) -> DataFrame:
    """``qa_id`` is ``conversation-turn``, so ids cannot meet."""
    conv = read_table(spark, base, "conversations").select("conv_id", "turn", "role", "text")
    return (with_next_turn(conv).where("role = 'user' AND next_role = 'assistant'")
            .select(F.concat_ws("-", F.col("conv_id").cast("string"), F.col("turn").cast("string")).alias("qa_id"),
                    F.col("text").alias("question"), F.col("next_text").alias("answer")))


def qa_pairs_sql() -> str:
    return ("SELECT concat_ws('-', conv_id, turn) AS qa_id, text AS question, next_text AS answer FROM ("
            "SELECT *, lead(role) OVER w AS next_role, lead(text) OVER w AS next_text FROM conversations "
            "WINDOW w AS (PARTITION BY conv_id ORDER BY turn, role, text)) "
            "WHERE role = 'user' AND next_role = 'assistant'")


_A = "(5 + (l_orderkey + l_partkey) % 46)"
_B = "(2 + (l_suppkey + l_linenumber) % 19)"
_T = f"(l_partkey % {len(K.QA_TEMPLATES)})"


def _fill(template: str) -> list:
    """Split a template on {a} {b} {d} {r} into literal / field pieces."""
    pieces, rest = [], template
    while "{" in rest:
        lit, tail = rest.split("{", 1)
        name, rest = tail.split("}", 1)
        pieces.append(("lit", lit))
        pieces.append(("field", name))
    pieces.append(("lit", rest))
    return [p for p in pieces if p[1] != ""]


def _result_expr(kind: str, a: str, b: str) -> str:
    if kind == "gives":
        return f"({a} - {b})"
    if kind == "weekly":
        return f"({a} * {b} * 7)"
    if kind == "groups":
        return f"({a} // {b})"
    return f"({a} * {b})"


def synthesize_qa(spark: SparkSession, base: str) -> DataFrame:
    # spread the narrow numeric rows before any text is built from them
    li = spread(read_table(spark, base, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"))
    a, b, t = F.expr(_A), F.expr(_B), F.expr(_T)

    def chosen(per_template):
        value = F
        for i, v in enumerate(per_template):
            value = value.when(t == i, v)
        return value

    r = chosen([{"gives": a - b, "weekly": a * b * 7, "groups": F.floor(a / b)}.get(kind, a * b)
                for _, _, kind in K.QA_TEMPLATES])
    # numbers become text once, in a projection of their own: rendered inside every template, they
    # make the compiled method of the stage too long for the JVM to optimise
    fields = {"a": a, "b": b, "d": a * b, "r": r}
    li = li.select("*", *[v.cast("bigint").cast("string").alias(f"_{n}") for n, v in fields.items()])

    def build(template):
        return F.concat(*[F.lit(x) if k == "lit" else F.col(f"_{x}") for k, x in _fill(template)])

    q_expr, ans_expr = (chosen([build(templates[n]) for templates in K.QA_TEMPLATES]) for n in (0, 1))
    return li.select(line_key().alias("qa_id"),
                     t.cast("int").alias("template_no"), q_expr.alias("question"),
                     ans_expr.alias("answer"))


def synthesize_qa_sql() -> str:
    def build(template, kind):
        r = _result_expr(kind, _A, _B)
        v = {"a": _A, "b": _B, "d": f"({_A} * {_B})", "r": r}
        parts = []
        for k, x in _fill(template):
            parts.append("'" + x.replace("'", "''") + "'" if k == "lit"
                         else f"CAST(CAST({v[x]} AS BIGINT) AS VARCHAR)")
        return " || ".join(parts)
    qc = " ".join(f"WHEN {i} THEN {build(tq, kind)}" for i, (tq, _, kind) in enumerate(K.QA_TEMPLATES))
    ac = " ".join(f"WHEN {i} THEN {build(ta, kind)}" for i, (_, ta, kind) in enumerate(K.QA_TEMPLATES))
    return (f"SELECT {LINE_KEY_SQL} AS qa_id, CAST({_T} AS INTEGER) AS template_no, "
            f"CASE {_T} {qc} END AS question, CASE {_T} {ac} END AS answer FROM lineitem")

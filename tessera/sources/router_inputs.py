"""A free-text query table built from ``lineitem`` rows, for routing workloads.

Each line item becomes one question; the template is picked by
``pmod(l_orderkey * 7 + l_linenumber, N)`` and filled with the row's numbers.  The table
only supplies text of the expected schema ``(query_id, query)``; routing it is the job of
:mod:`tessera.operators.router`, which sees nothing but the text.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.sources.qa import LINE_KEY_SQL, line_key
from tessera.session import spread
from tessera.sources.tables import read_table

# Question templates; {q} quantity, {l} line number, {o} order key, {p} part key,
# {s} supplier key, {z} line number mod 3, {t} tax in percent.
TEMPLATES = [
    "Dana had {q} crates in the yard and loses {l} on the road, how many crates are left?",
    "Solve {q} * {l} + {p} / 4",
    "A depot ships {q} boxes per week at ${s} for each box. What does a week bring in?",
    "Which privacy regulation covers the archive of invoice {o} in the UK?",
    "Can a landlord end tenancy contract {o} without notice?",
    "Debug the TypeError in my Java method for invoice {o}",
    "Write a SQL function that lists supplier {s} for part {p}",
    "Describe the osmosis of water through cell membrane {l}.",
    "Who shipped order {o}?",
    "Share {q} dollars by {z}",
    "Compute the total of {q} and {t} kg",
    "What is {q} - {l}?",
    "{q} / {l} + {t}",
    "Calculate {q} * {l}",
]

# The same questions, but the one on osmosis asks "how" and has a number, which makes it a word
# problem without enough numbers instead of a science question.
WORD_TEMPLATES = ["How does osmosis move water through cell membrane {l}?" if t.startswith("Describe the osmosis") else t
                  for t in TEMPLATES]

FIELDS = {
    "q": "CAST(l_quantity AS INT)",
    "l": "l_linenumber",
    "o": "l_orderkey",
    "p": "l_partkey",
    "s": "l_suppkey",
    "z": "(l_linenumber % 3)",
    "t": "CAST(round(l_tax * 100) AS INT)",
}


def _parts(template: str) -> list[tuple[str, str]]:
    """Split a template into (literal, field) pairs; field may be ''."""
    out, rest = [], template
    while "{" in rest:
        lit, tail = rest.split("{", 1)
        name, rest = tail.split("}", 1)
        out.append((lit, name))
    out.append((rest, ""))
    return out


def template_column(template: str):
    pieces = []
    for lit, name in _parts(template):
        if lit:
            pieces.append(F.lit(lit))
        if name:
            pieces.append(F.expr(FIELDS[name]).cast("string"))
    return F.concat(*pieces)


def template_sql(template: str) -> str:
    pieces = []
    for lit, name in _parts(template):
        if lit:
            pieces.append("'" + lit.replace("'", "''") + "'")
        if name:
            pieces.append(f"CAST({FIELDS[name]} AS VARCHAR)")
    return " || ".join(pieces)


def selector_sql() -> str:
    return f"((l_orderkey * 7 + l_linenumber) % {len(TEMPLATES)} + {len(TEMPLATES)}) % {len(TEMPLATES)}"


def router_queries(spark: SparkSession, base: str, templates: list[str] = TEMPLATES) -> DataFrame:
    """``(query_id, template_no, query)``, one row per line item.  ``templates``: as many as ``TEMPLATES``."""
    # spread the narrow numeric rows before any text is built from them
    li = spread(read_table(spark, base, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_tax"))
    sel = F.pmod(F.col("l_orderkey") * 7 + F.col("l_linenumber"), F.lit(len(TEMPLATES)))
    text = None
    for i, t in enumerate(templates):
        text = (F.when(sel == i, template_column(t)) if text is None
                else text.when(sel == i, template_column(t)))
    return li.select(line_key().alias("query_id"),
                     sel.cast("int").alias("template_no"), text.alias("query"))


def router_queries_sql(templates: list[str] = TEMPLATES) -> str:
    cases = " ".join(f"WHEN {i} THEN {template_sql(t)}" for i, t in enumerate(templates))
    return (f"SELECT {LINE_KEY_SQL} AS query_id, "
            f"CAST({selector_sql()} AS INTEGER) AS template_no, "
            f"CASE {selector_sql()} {cases} END AS query, "
            f"CAST(l_quantity AS INT) AS q, l_linenumber AS l, l_partkey AS p, "
            f"CAST(round(l_tax * 100) AS INT) AS t FROM lineitem")

"""The router: classification + ordered module dispatch + log.

Routing a table is a few narrow projections: classification columns, the first module whose
``can_handle`` accepts the type (registration order), that module's result struct, and the
log columns.  No shuffle.  The only Python step is the arithmetic branch of the math
module, and it receives NULL on every row that does not need it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.functions import constants as K
from tessera.operators.router import classify as CL
from tessera.operators.router.handlers import DEFAULT_MODULES, GENERAL, Module


class Router:
    def __init__(self, modules: list[Module] | None = None, rules=None) -> None:
        self.modules: list[Module] = list(modules or [])
        self.rules = [(t, list(p)) for t, p in (rules or K.CLASSIFIER_RULES)]

    def register(self, module: Module, rules: list[str] | None = None,
                 before: str | None = None) -> "Router":
        """Append a module (fluent).  ``rules`` adds classifier patterns for a new query
        type named like the module, so type and handler arrive together; ``before``
        inserts the module ahead of an already registered one (e.g. ``"general"``, which
        accepts every type)."""
        if rules is not None:
            pos = next((i for i, (t, _) in enumerate(self.rules) if t == "general"),
                       len(self.rules))
            self.rules.insert(pos, (module.name, list(rules)))
        if before is not None:
            idx = next(i for i, m in enumerate(self.modules) if m.name == before)
            self.modules.insert(idx, module)
        else:
            self.modules.append(module)
        return self

    @property
    def types(self) -> list[str]:
        return [t for t, _ in self.rules]

    def classify(self, query: Column) -> dict[str, Column]:
        scores = CL.scores(query, self.rules)
        out = {f"score_{t}": c for t, c in scores.items()}
        out.update(CL.flags(query))
        out["query_type"] = CL.winner(scores)
        return out

    def classified(self, df: DataFrame, query_col: str = "query") -> DataFrame:
        """Adds: score_<type>.., has_numbers, has_operator, has_code, detected.

        Signals and scores are projections of their own and what is derived from them comes out
        of a generator of one row: a pattern is matched once for each row, however often the
        result is compared, and a filter on the type does not bring the patterns along."""
        q = F.col(query_col)
        signals = {n: (f"_cls_{n}", c) for n, c in CL.signals(q).items()}
        staged = df.select("*", *[c.alias(at) for at, c in signals.values()])
        known = {n: F.col(at) for n, (at, _) in signals.items()}
        scores = CL.scores(q, self.rules, known=known)
        staged = staged.select("*", F.array(*scores.values()).alias("_cls_scores"))
        by_type = {t: F.get("_cls_scores", i) for i, t in enumerate(scores)}
        out = {f"score_{t}": c for t, c in by_type.items()}
        out.update({n: known[n] for n in ("has_numbers", "has_operator", "has_code")})
        out["detected"] = CL.winner(by_type)
        return staged.select(*df.columns, F.inline(F.array(F.struct(*[c.alias(n) for n, c in out.items()]))))

    def route(self, df: DataFrame, query_col: str = "query") -> DataFrame:
        """Adds: score_<type>.., has_numbers, has_operator, has_code, detected,
        module_used, result (struct), and the flattened answer / confidence / reasoning."""
        q = F.col(query_col)
        staged = self.classified(df, query_col)
        qt = F.col("detected")
        # per-module intermediate columns, computed once on the rows the module serves
        taken = F.lit(False)
        prep_cols = []
        for m in self.modules:
            ok = m.can_handle(qt)
            if m.prepare is not None:
                for key, col in m.prepare(q, ok & ~taken).items():
                    prep_cols.append(F.when(ok & ~taken, col).alias(f"_{m.name}_{key}"))
            taken = taken | ok
        if prep_cols:
            staged = staged.select("*", *prep_cols)
        used = None
        res = None
        taken = F.lit(False)
        for m in self.modules:
            ok = m.can_handle(qt)
            sel = ok & ~taken
            used = F.when(ok, F.lit(m.name)) if used is None else used.when(ok, F.lit(m.name))
            r = m.handle(q, sel)
            res = F.when(ok, r) if res is None else res.when(ok, r)
            taken = taken | ok
        fallback = GENERAL.handle(q, ~taken)
        used = F.lit(GENERAL.name) if used is None else used.otherwise(F.lit(GENERAL.name))
        res = fallback if res is None else res.otherwise(fallback)
        internal = [c for c in staged.columns if c.startswith("_") and c not in df.columns]
        # from a generator as well: a filter on the result would build all of it a second time
        routed = staged.select("*", used.alias("module_used"),
                               F.inline(F.array(F.struct(res.alias("result"))))).drop(*internal)
        return routed.select("*", F.col("result.answer").alias("answer"),
                             F.col("result.confidence").alias("confidence"),
                             F.col("result.reasoning").alias("reasoning"))


def default_router() -> Router:
    """Math, legal, code, science, general (general last: it accepts every type)."""
    return Router(DEFAULT_MODULES)


def call_log(routed: DataFrame, query_col: str = "query", id_col: str = "query_id") -> DataFrame:
    """Query cut to 100 characters, detected type, module used, confidence."""
    return routed.select(id_col, F.substring(F.col(query_col), 1, K.LOG_QUERY_CHARS).alias("query"),
                         "detected", "module_used", "confidence")

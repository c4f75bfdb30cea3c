"""First-match-wins keyword categorisation as one CASE expression.

The rule list is data; the expression is a chain of ``when`` branches, one per
rule, each an OR of ``contains`` tests on the lower-cased text. Catalyst keeps
it inside whole-stage codegen; no UDF and no join is involved.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from ticketflow.settings import CATEGORY_RULES, DEFAULT_CATEGORY
from ticketflow.functions.text import col_of

Rules = Sequence[tuple[str, Sequence[str]]]


def categorize(c: str | Column, rules: Rules = CATEGORY_RULES,
               default: str = DEFAULT_CATEGORY) -> Column:
    """Category of the first rule with a keyword contained in ``lower(c)``.

    NULL text yields the default (no keyword can match).
    """
    text = F.lower(col_of(c))
    expr = None
    for category, keywords in rules:
        hit = None
        for kw in keywords:
            test = text.contains(F.lit(kw.lower()))
            hit = test if hit is None else (hit | test)
        if hit is None:
            continue
        hit = F.coalesce(hit, F.lit(False))
        expr = F.when(hit, F.lit(category)) if expr is None else expr.when(hit, F.lit(category))
    if expr is None:
        return F.lit(default)
    return expr.otherwise(F.lit(default))


def categorize_sql(text_sql: str, rules: Rules = CATEGORY_RULES,
                   default: str = DEFAULT_CATEGORY) -> str:
    """The same rule list as an ANSI ``CASE`` (used to build oracle SQL)."""

    def q(s: str) -> str:
        return "'" + s.replace("'", "''") + "'"

    branches = []
    for category, keywords in rules:
        if not keywords:
            continue
        tests = " OR ".join(f"contains(lower({text_sql}), {q(kw.lower())})" for kw in keywords)
        branches.append(f"WHEN coalesce({tests}, false) THEN {q(category)}")
    if not branches:
        return q(default)
    return "CASE " + " ".join(branches) + f" ELSE {q(default)} END"

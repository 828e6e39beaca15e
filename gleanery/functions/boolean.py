"""Boolean search expressions as conditions on a text.

``"data engineer" AND (python OR scala) NOT senior``: quoted phrases, runs of plain words (a phrase too), brackets and the
upper-case words NOT, AND, OR, which bind in this order; what stands side by side without one has to hold together. A phrase
holds where the lower-case text contains it.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, functions as F
from pyspark.sql.types import BooleanType

from .text import as_col, let, or_empty

_TOKEN = re.compile(r'"([^"]*)"|([()])|([^\s()"]+)|(")')
_STRENGTH = {"OR": 1, "AND": 2, "NOT": 3}


class ExpressionError(ValueError):
    """A search expression with brackets or quotes that do not match, or an operator without an operand."""


def _tokens(expression: str) -> list[tuple[str, str]]:
    """(kind, text) with kinds phrase, operator, ( and ); runs of plain words are joined."""
    out: list[tuple[str, str]] = []
    plain = False  # whether the last token is a run of plain words
    for quoted, bracket, word, stray in _TOKEN.findall(expression):
        if stray:
            raise ExpressionError(f"a quote is not closed: {expression}")
        if word in _STRENGTH:
            out.append(("operator", word))
            plain = False
        elif word:
            out.append(("phrase", f"{out.pop()[1]} {word}" if plain else word))
            plain = True
        else:
            out.append((bracket, bracket) if bracket else ("phrase", quoted.strip()))
            plain = False
    return [t for t in out if t != ("phrase", "")]


@lru_cache(maxsize=4096)
def parse(expression: str) -> tuple[tuple[str, str], ...]:
    """The expression in postfix order: ("phrase", text in lower case) and ("operator", name)."""
    out: list[tuple[str, str]] = []
    waiting: list[str] = []  # operators and open brackets
    operand_before = False

    def apply(strength: int) -> None:
        while waiting and waiting[-1] != "(" and _STRENGTH[waiting[-1]] >= strength:
            out.append(("operator", waiting.pop()))

    for kind, text in _tokens(expression):
        starts = kind in ("phrase", "(") or text == "NOT"
        if starts and operand_before:
            apply(_STRENGTH["AND"])
            waiting.append("AND")
        if kind == "phrase":
            out.append((kind, text.lower()))
        elif kind == "(" or text == "NOT":
            waiting.append(text)
        elif not operand_before:
            raise ExpressionError(f"nothing stands before {text}: {expression}")
        elif kind == ")":
            apply(0)
            if not waiting:
                raise ExpressionError(f"a bracket is not opened: {expression}")
            waiting.pop()
        else:
            apply(_STRENGTH[text])
            waiting.append(text)
        operand_before = kind in ("phrase", ")")
    if not operand_before and (out or waiting):
        raise ExpressionError(f"nothing stands at the end: {expression}")
    apply(0)
    if waiting:
        raise ExpressionError(f"a bracket is not closed: {expression}")
    return tuple(out)


def _evaluate(expression: str, holds: Callable, negate: Callable):
    """The value of an expression from the values of its phrases; None for one without phrases."""
    stack: list = []
    for kind, text in parse(expression):
        if kind == "phrase":
            stack.append(holds(text))
        elif text == "NOT":
            stack.append(negate(stack.pop()))
        else:
            right, left = stack.pop(), stack.pop()
            stack.append(left & right if text == "AND" else left | right)
    return stack[0] if stack else None


def matches_expression(text: Column | str, expression: str) -> Column:
    """Whether a text satisfies a search expression; true for an empty one. The text is put in lower case once; null is empty."""
    parse(expression)

    def test(lowered: Column) -> Column:
        found = _evaluate(expression, lambda p: F.contains(lowered, F.lit(p)), lambda c: ~c)
        return F.lit(True) if found is None else found

    return let(F.lower(or_empty(text)), test)


@F.arrow_udf(BooleanType())
def _each(texts: pa.Array, expressions: pa.Array) -> pa.Array:
    out = []
    for text, expression in zip(texts.to_pylist(), expressions.to_pylist()):
        try:
            found = None if expression is None else _evaluate(expression, lambda p: p in text, lambda x: not x)
            out.append(found if found is not None or expression is None else True)
        except ExpressionError:
            out.append(None)
    return pa.array(out, pa.bool_())


def matches_stored_expression(text: Column | str, expression: Column | str) -> Column:
    """The same with an expression of each row; null for one that is null or cannot be read."""
    return _each(F.lower(or_empty(text)), as_col(expression))

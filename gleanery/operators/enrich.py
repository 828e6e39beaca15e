"""Batched text enrichment, table side: requests, answers, fallback.

Requests and answers are tables. Whatever answers a request is a plain function that runs
inside the tasks; the library ships no client.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from .. import fixed_values as fv
from ..functions.arrays import distinct_ci, no_strings
from ..functions.skills import (
    INSIGHT_FIELDS,
    INSIGHT_TYPE,
    empty_insight,
    insight_for_mode,
    local_insight,
    local_skills,
    normalize_skills,
)
from ..functions.text import as_col, let, nonempty, or_empty, strip
from ..session import materialize
from .limits import batch_ids


def build_requests(
    texts: DataFrame,
    *,
    kind: str,
    key: str = "id",
    text: str = "text",
    order: str = "ord",
    partition_by: Sequence[str] = (),
    size: int = fv.TEXTS_PER_REQUEST,
    max_chars: int | None = None,
) -> DataFrame:
    """One row per request: ``batch_id``, ``member_ids`` in order and the ``prompt``.

    ``kind`` is 'skills' or 'insights'. Whole texts go into the prompt; where the service has a
    limit, ``max_chars`` cuts them before they are shuffled.
    """
    body = strip(or_empty(text))
    cut = body if max_chars is None else F.substring(body, 1, max_chars)
    if kind == "skills":
        over = F.lit(False) if max_chars is None else F.length(body) > max_chars
        shown = F.when(body == "", F.lit(fv.NO_DESCRIPTION)).when(over, F.concat(cut, F.lit("..."))).otherwise(cut)
        head, sep, label = fv.SKILL_REQUEST_TEXT + "\n\n", "\n\n", lambda i: F.concat(i, F.lit(". "))
    elif kind == "insights":
        shown = cut
        head, sep = "\n".join([*fv.INSIGHT_REQUEST_LINES, "", ""]), "\n"
        label = lambda i: F.concat(F.lit("CONTENT "), i, F.lit(":\n"))
    else:
        raise ValueError(f"unknown request kind: {kind}")
    short = texts.select(*partition_by, F.col(key).alias("_key"), F.col(order).alias("_ord"), shown.alias("_text"))
    numbered = batch_ids(short, size, "_ord", partition_by)
    members = F.array_sort(F.collect_list(F.struct("batch_pos", "_key", "_text")))
    grouped = numbered.groupBy(*partition_by, "batch_id").agg(members.alias("_m"))
    parts = F.transform(
        "_m", lambda m: F.concat(label((m["batch_pos"] + 1).cast("string")), m["_text"])
    )
    return grouped.select(
        *partition_by,
        "batch_id",
        F.transform("_m", lambda m: m["_key"]).alias("member_ids"),
        F.concat(F.lit(head), F.array_join(parts, sep)).alias("prompt"),
    )


def answer_requests(requests: DataFrame, answer: Callable[[str], str | None], keys: Sequence[str] = ("batch_id",)) -> DataFrame:
    """Run a function over the prompts, batch by batch inside the tasks: ``raw`` is the answer, ``error``
    the message of a call that failed, whose answer is null."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        def called(prompt):
            try:
                return answer(prompt), None
            except Exception as failure:
                return None, f"{type(failure).__name__}: {failure}"

        for batch in batches:
            found = [called(p) for p in batch["prompt"]]
            yield batch[list(keys)].assign(raw=[a for a, _ in found], error=[e for _, e in found])

    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in requests.schema.fields if f.name in keys]
    return requests.select(*keys, "prompt").mapInPandas(run, ", ".join([*fields, "raw string", "error string"]))


# ---- answers ----


def _kind(value: Column) -> Column:
    return F.schema_of_variant(value)


def _item_text(value: Column) -> Column:
    """Text of a JSON item, trimmed; null, true and false as None, True and False."""
    text = (
        F.when(F.is_variant_null(value), F.lit("None"))
        .when(_kind(value) == "BOOLEAN", F.initcap(F.try_variant_get(value, "$", "string")))
        .otherwise(F.coalesce(F.try_variant_get(value, "$", "string"), F.to_json(value)))
    )
    return strip(text)


def _items(value: Column) -> Column:
    """List items as texts, a single string as one item, anything else as none."""
    many = F.try_variant_get(value, "$", "array<variant>")
    texts = F.filter(F.transform(many, _item_text), lambda x: x != "")
    one = F.when(_kind(value) == "STRING", nonempty(strip(F.try_variant_get(value, "$", "string"))))
    return F.when(many.isNotNull(), texts).when(one.isNotNull(), F.array(one)).otherwise(no_strings())


def _json(raw: Column, pattern: str) -> Column:
    """JSON of an answer, or of the bracketed part inside noise."""
    return F.coalesce(
        F.try_parse_json(raw), F.try_parse_json(nonempty(F.regexp_extract(raw, pattern, 0)))
    )


_OUTERMOST = r"\[[\s\S]+\]"


def _list_of(value: Column) -> Column:
    return F.try_variant_get(value, "$", "array<variant>")


def skill_answer(raw: Column | str, expected: Column | str) -> Column:
    """Skill lists of one answer, one per text; null when the answer does not fit."""
    found = _list_of(_json(as_col(raw), _OUTERMOST))
    return let(found, lambda xs: F.when(F.size(xs) == as_col(expected), F.transform(xs, _items)))


def insight_answer(raw: Column | str, expected: Column | str) -> Column:
    """Insights of one answer, one per text; null when the answer does not fit.

    A single object stands for the first text, and missing ones are filled with empty
    insights; any other difference in length, or an element that is no object, rejects the
    answer.
    """
    wanted = as_col(expected)

    def insight(element: Column) -> Column:
        return F.struct(
            *[
                F.coalesce(_items(F.try_variant_get(element, f"$.{n}", "variant")), no_strings()).alias(n)
                for n in INSIGHT_FIELDS
            ]
        )

    def is_object(element: Column) -> Column:
        return _kind(element).startswith("OBJECT")

    def read(value: Column) -> Column:
        elements = F.when(is_object(value), F.array(value)).otherwise(_list_of(value))

        def fit(xs: Column) -> Column:
            read_all = F.transform(xs, insight)
            padded = F.concat(
                read_all, F.array_repeat(empty_insight(), (wanted - 1).cast("int"))
            )
            return (
                F.when(~F.forall(xs, is_object), F.lit(None))
                .when(F.size(xs) == wanted, read_all)
                .when((F.size(xs) == 1) & (wanted > 1), padded)
            )

        return let(elements, fit)

    return let(_json(as_col(raw), _OUTERMOST), read)


def member_rows(requests: DataFrame, answers: DataFrame, parsed: Column, name: str, keys: Sequence[str] = ("batch_id",)) -> DataFrame:
    """One row per text: its id and its part of the answer, null without a fitting answer.
    ``parsed`` may use ``raw`` and ``expected``."""
    joined = requests.select(*keys, "member_ids", F.size("member_ids").alias("expected")).join(
        answers, list(keys), "left"
    )
    return joined.select(*keys, "member_ids", parsed.alias("_parsed")).select(
        *keys, F.posexplode("member_ids").alias("batch_pos", "member_id"), "_parsed"
    ).select(*keys, "member_id", F.get("_parsed", F.col("batch_pos")).alias(name))


def answered_texts(
    texts: DataFrame,
    answer: Callable[[str], str | None],
    *,
    kind: str,
    key: str,
    text: str,
    order: str,
    parsed: Column,
    size: int = fv.TEXTS_PER_REQUEST,
    max_chars: int | None = None,
) -> DataFrame:
    """Requests, answers and their reading in one: ``member_id``, ``answered`` (null without a fitting
    answer) and ``error`` for each text. Every request is answered once: the answers are stored."""
    if answer is None:
        raise ValueError("external extraction needs an answer function")
    requests = materialize(
        build_requests(texts, kind=kind, key=key, text=text, order=order, size=size, max_chars=max_chars)
    )
    answers = materialize(answer_requests(requests, answer))
    found = member_rows(requests, answers, parsed, "answered")
    return found.join(answers.select("batch_id", "error"), "batch_id", "left").drop("batch_id")


def skills_or_fallback(answered: Column | str, fallback: Column | str) -> Column:
    """Normalized answered skills, else normalized rule-based ones when the answer did not
    fit."""
    return normalize_skills(F.coalesce(as_col(answered), as_col(fallback)))


def keep_nonempty(new: Column | str, old: Column | str) -> Column:
    """The new list unless it is empty."""
    return F.when(F.size(F.coalesce(as_col(new), no_strings())) > 0, as_col(new)).otherwise(as_col(old))


def insight_or_fallback(answered: Column | str, text: Column | str) -> Column:
    """The answered insight when it fits and says anything, else the rule-based one."""
    a = as_col(answered)
    says = None
    for n in INSIGHT_FIELDS:
        test = F.size(F.coalesce(a[n], no_strings())) > 0
        says = test if says is None else says | test
    return F.when(a.isNotNull() & says, a).otherwise(local_insight(text).cast(INSIGHT_TYPE))


def skills_for_mode(mode: str, description: Column | str, section_skills: Column | str) -> Column:
    """Skills by the chosen way; an empty result leaves the section skills in place."""
    if mode == "heuristic":
        found = normalize_skills(section_skills)
    elif mode == "local":
        found = local_skills(description, section_skills, hashtags=False)
    else:
        raise ValueError(f"unknown skill mode: {mode}")
    return let(found, lambda f: keep_nonempty(f, section_skills))


def insights_for_mode(texts: DataFrame, text: str, mode: str | None, name: str = "insight") -> DataFrame:
    return texts.withColumn(name, insight_for_mode(text, mode))


def parse_skill_list(raw: Column | str) -> Column:
    """One lenient skill list: JSON list, object with a list inside, else text split at
    separators."""
    text = or_empty(raw)

    def lists(value: Column) -> Column:
        inside = [
            F.coalesce(F.try_variant_get(value, f"$.{n}", "array<string>"), no_strings())
            for n in ("skills", "skill_list", "list")
        ]
        return F.coalesce(F.try_variant_get(value, "$", "array<string>"), F.concat(*inside))

    parsed = F.coalesce(let(_json(text, r"\[[^\]]+\]"), lists), no_strings())
    chosen = let(parsed, lambda p: F.when(F.size(p) > 0, p).otherwise(F.split(text, r"[\n,;•\-]+", -1)))
    trimmed = F.transform(chosen, lambda x: F.btrim(or_empty(x), F.lit(" -*•\t\r\n")))
    return distinct_ci(F.filter(trimmed, lambda x: x != ""))

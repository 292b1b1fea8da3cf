"""JSON messages exchanged with embedding and chat models."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from pagewell.functions import let
from pagewell.functions.vectors import has_dimension
from pagewell.settings import (
    CONTEXT_SEPARATOR,
    DOCUMENT_TASK,
    EMBEDDING_DIM,
    PROMPT_TEMPLATE,
)


def embedding_request(
    texts: Column, model: str, dim: int = EMBEDDING_DIM, task: str = DOCUMENT_TASK
) -> Column:
    """Body of one batch request; keys in alphabetical order."""

    def entry(text: Column) -> Column:
        return F.struct(
            F.struct(F.array(F.struct(text.alias("text"))).alias("parts")).alias("content"),
            F.lit(model).alias("model"),
            F.lit(dim).alias("output_dimensionality"),
            F.lit(task).alias("task_type"),
        )

    return F.to_json(F.struct(F.transform(texts, entry).alias("requests")))


def _path(value: Column, path: str, kind: str) -> Column:
    return F.try_variant_get(value, path, kind)


def _listed_values(entries: Column) -> Column:
    """Vectors of the entries that have ``values``; others are skipped. A vector
    that is not a list of numbers comes out NULL or with NULL entries."""
    present = F.filter(entries, lambda e: _path(e, "$.values", "variant").isNotNull())
    return F.transform(present, lambda e: _path(e, "$.values", "array<float>"))


def response_vectors(body: Column) -> Column:
    """All vectors of a response body, in order: ``array<array<float>>``.

    Known shapes: ``responses[].embedding.values``,
    ``responses[].embeddings[].values`` and ``embeddings[].values``; a
    ``responses`` list wins over ``embeddings``. An unreadable body or one of no
    known shape gives an empty list.
    """
    nothing = F.lit(None).cast("array<array<float>>")

    def from_responses(response: Column) -> Column:
        single = _path(response, "$.embedding.values", "variant")
        several = _path(response, "$.embeddings", "array<variant>")
        return F.when(
            single.isNotNull(), F.array(_path(response, "$.embedding.values", "array<float>"))
        ).otherwise(F.coalesce(_listed_values(several), F.array().cast("array<array<float>>")))

    def read(parsed: Column) -> Column:
        responses = _path(parsed, "$.responses", "array<variant>")
        embeddings = _path(parsed, "$.embeddings", "array<variant>")
        return F.coalesce(
            F.flatten(F.transform(responses, from_responses)),
            F.coalesce(_listed_values(embeddings), nothing),
            F.array().cast("array<array<float>>"),
        )

    return let(F.try_parse_json(body), read)


def is_success(status: Column) -> Column:
    return F.coalesce(status.between(200, 299), F.lit(False))


def rejection_reason(status: Column, vectors: Column, expected: Column, dim: int) -> Column:
    """Why a response batch is unusable; NULL for a usable one."""
    return (
        F.when(~is_success(status), F.lit("status"))
        .when(~F.forall(vectors, lambda v: has_dimension(v, dim)), F.lit("dimension"))
        .when(F.size(vectors) != expected, F.lit("count"))
    )


def prompt(context: Column, question: Column) -> Column:
    return F.format_string(PROMPT_TEMPLATE, context, question)


def join_context(texts: Column) -> Column:
    return F.array_join(texts, CONTEXT_SEPARATOR)


def chat_answer(body: Column) -> Column:
    """Text of the first part of the first candidate; NULL if there is none."""
    return F.get_json_object(body, "$.candidates[0].content.parts[0].text")

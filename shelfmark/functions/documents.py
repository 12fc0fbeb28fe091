"""Reading fields out of a JSON document column."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F, types as T

from shelfmark.functions.json_text import json_text


@dataclass(frozen=True)
class Elements:
    """An array of objects at a top-level path, each object cut to some fields."""

    path: str
    fields: tuple[str, ...]


@dataclass(frozen=True)
class Container:
    """An array or object at a path, as the canonical text of a binary JSON value."""

    path: str


Paths = Mapping[str, str | Elements | Container]


def document_schema(paths: Iterable[str | Elements | Container]) -> T.StructType:
    """A schema holding just these dotted paths and arrays, every leaf as text."""
    tree: dict = {}
    for path in paths:
        if isinstance(path, Elements):
            fields = [T.StructField(f, T.StringType()) for f in path.fields]
            tree[path.path] = T.ArrayType(T.StructType(fields))
            continue
        node = tree
        *parents, leaf = (path.path if isinstance(path, Container) else path).split(".")
        for parent in parents:
            node = node.setdefault(parent, {})
        node[leaf] = T.StringType()

    def build(node: dict) -> T.StructType:
        return T.StructType([
            T.StructField(name, build(child) if isinstance(child, dict) else child)
            for name, child in node.items()
        ])

    return build(tree)


def with_document_fields(
    df: DataFrame, document: str, paths: Paths, keep: Iterable[str]
) -> DataFrame:
    """``keep`` columns plus one column per entry of ``paths``: text, or an array of structs.

    A ``Container`` is written as the database writes an array or object; text of another kind
    at its path stays as it is.

    The document is parsed once per row, against a schema of the wanted paths only. A
    field is NULL where its path is missing, JSON null, or of another kind.
    """
    keep = list(keep)
    parsed = df.select(*keep, F.from_json(document, document_schema(paths.values())).alias("_doc"))

    def field(path: str | Elements | Container) -> Column:
        if isinstance(path, Container):
            return json_text(F.col(f"_doc.{path.path}"))
        return F.col(f"_doc.{path.path if isinstance(path, Elements) else path}")

    return parsed.select(*keep, *(field(path).alias(name) for name, path in paths.items()))


def explode_elements(df: DataFrame, elements: str, fields: Iterable[str]) -> DataFrame:
    """One row per element of an array column: the other columns, the element's ``fields``
    and its 1-based ``ordinality``. Rows without the array, or with an empty one, vanish.

    They are dropped after the explode: for a plain one Spark first filters by the array's
    size, and to do so parses every document a second time.
    """
    others = [c for c in df.columns if c != elements]
    exploded = df.select(*others, F.posexplode_outer(elements).alias("_pos", "_element"))
    return exploded.where(F.col("_pos").isNotNull()).select(
        *others,
        *(F.col(f"_element.{f}").alias(f) for f in fields),
        (F.col("_pos") + 1).cast("bigint").alias("ordinality"),
    )

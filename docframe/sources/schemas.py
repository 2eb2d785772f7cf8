"""Extraction schemas: the fields and line-item columns of a document type.

Schema files are JSON. They are read as a table with one row per column, by
Spark like any other input; operators take the few columns of a schema as a
``Schema`` and put them into plans as literals, so nothing is joined on a name.
"""

from __future__ import annotations

import json
from importlib import resources
from itertools import groupby
from typing import NamedTuple

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

COLUMN = "struct<name:string,type:string,required:boolean,description:string,aliases:array<string>>"
# The keys of a schema file.
FILE = f"document_type string, description string, fields array<{COLUMN}>, line_items array<{COLUMN}>"


class SchemaError(Exception):
    """A schema file that is missing, is no JSON object, lists no fields, or has the type of another."""


class Column(NamedTuple):
    name: str
    type: str = "string"
    required: bool = False
    note: str = ""
    aliases: tuple[str, ...] = ()


class Schema(NamedTuple):
    """The columns of one document type."""

    document_type: str
    fields: tuple[Column, ...]
    items: tuple[Column, ...] = ()
    about: str = ""

    @property
    def names(self) -> list[str]:
        return [c.name for c in self.fields]

    @property
    def required(self) -> list[str]:
        return [c.name for c in self.fields if c.required]

    @property
    def item_names(self) -> list[str]:
        return [c.name for c in self.items]

    @property
    def types(self) -> dict[str, str]:
        return {c.name: c.type for c in self.fields}

    @property
    def aliases(self) -> dict[str, str]:
        """Field name by each spelling a document may use; a field's own name wins."""
        spelled = {a: c.name for c in self.fields for a in c.aliases}
        return spelled | {c.name: c.name for c in self.fields}


def _bundled_texts() -> list[tuple[str, str]]:
    folder = resources.files("docframe") / "schemas"
    found = sorted((f for f in folder.iterdir() if f.name.endswith(".json")), key=lambda f: f.name)
    return [(f.name, f.read_text("utf-8")) for f in found]


def bundled(spark: SparkSession) -> DataFrame:
    """(file, text) of the schemas that come with the library."""
    return spark.createDataFrame(_bundled_texts(), "file string, text string")


def local_schemas() -> dict[str, Schema]:
    """The schemas that come with the library, without a session."""
    out = {}
    for _, text in _bundled_texts():
        raw = json.loads(text)
        columns = lambda part: tuple(
            Column(c["name"], c.get("type", "string"), c.get("required", False), c.get("description", ""), tuple(c.get("aliases", ())))
            for c in raw[part]
        )
        out[raw["document_type"]] = Schema(raw["document_type"], columns("fields"), columns("line_items"), raw["description"])
    return out


def schema_files(spark: SparkSession, path: str) -> DataFrame:
    """(file, text) of the schema files below ``path``."""
    found = spark.read.option("pathGlobFilter", "*.json").text(path, wholetext=True)
    return found.select(F.col("_metadata.file_path").alias("file"), F.col("value").alias("text"))


def schema_columns(files: DataFrame) -> DataFrame:
    """One row per column: (document_type, about, part, ord, name, type, required, note, aliases), and ``file``.

    ``part`` is 'field' or 'item'. A file that is no schema gives one row without a name.
    """
    read = files.select("file", F.from_json("text", FILE).alias("s")).select("file", "s.*")
    part = lambda name, column: F.transform(
        F.coalesce(column, F.array().cast(f"array<{COLUMN}>")),
        lambda c, i: F.struct(
            F.lit(name).alias("part"),
            i.alias("ord"),
            c["name"].alias("name"),
            F.coalesce(c["type"], F.lit("string")).alias("type"),
            F.coalesce(c["required"], F.lit(False)).alias("required"),
            F.coalesce(c["description"], F.lit("")).alias("note"),
            F.coalesce(c["aliases"], F.array().cast("array<string>")).alias("aliases"),
        ),
    )
    columns = F.when(F.col("fields").isNotNull(), F.concat(part("field", F.col("fields")), part("item", F.col("line_items"))))
    return read.select(
        "file",
        F.coalesce("document_type", F.lit("unknown")).alias("document_type"),
        F.coalesce("description", F.lit("")).alias("about"),
        F.inline_outer(columns),
    )


def load_schemas(spark: SparkSession, path: str | None = None) -> dict[str, Schema]:
    """Schemas by document type, from the files at ``path`` or those that come with the library."""
    try:
        files = bundled(spark) if path is None else schema_files(spark, path)
        rows = schema_columns(files).orderBy("document_type", "part", "ord").collect()
    except AnalysisException as missing:
        raise SchemaError(f"no schema at {path}") from missing
    broken = sorted({r.file for r in rows if r.name is None})
    if broken or not rows:
        raise SchemaError(f"no schema with fields: {', '.join(broken) or path}")
    by_type: dict[str, set[str]] = {}
    for r in rows:
        by_type.setdefault(r.document_type, set()).add(r.file)
    several = {kind: sorted(of) for kind, of in by_type.items() if len(of) > 1}
    if several:
        raise SchemaError("; ".join(f"type {kind} in several files: {', '.join(of)}" for kind, of in several.items()))
    found = {}
    for (kind, about), columns in groupby(rows, lambda r: (r.document_type, r.about)):
        parts: dict[str, list[Column]] = {"field": [], "item": []}
        for r in columns:
            parts[r.part].append(Column(r.name, r.type, r.required, r.note, tuple(r.aliases)))
        found[kind] = Schema(kind, tuple(parts["field"]), tuple(parts["item"]), about)
    return found

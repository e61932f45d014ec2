"""JSON extraction from text columns.

All wanted fields of a document are read by ONE ``from_json`` pass. A scalar extraction must give NULL where the
document holds an object or an array, but ``from_json`` into a string gives their text. A value that merely looks like
a container (a string starting with a brace) is told apart by its variant type; only such rows pay for that.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_STEP = re.compile(r"\.([A-Za-z0-9_]+)|\['([^']+)'\]")


def path_steps(path: str) -> list[str]:
    """``$.a['$b'].c`` to ``['a', '$b', 'c']``."""
    steps, pos = [], 1
    while path.startswith("$") and pos < len(path):
        m = _STEP.match(path, pos)
        if not m:
            break
        steps.append(m.group(1) or m.group(2))
        pos = m.end()
    if not steps or pos != len(path):
        raise ValueError(f"unsupported JSON path {path!r}")
    return steps


def _schema_for(paths: list[list[str]]) -> T.StructType:
    fields: dict[str, list[list[str]]] = {}
    for head, *rest in paths:
        fields.setdefault(head, []).append(rest)
    out = T.StructType()
    for name, rests in fields.items():
        nested = [r for r in rests if r]
        if nested and len(nested) != len(rests):
            raise ValueError(f"field {name!r} is read both as a value and as an object")
        out.add(name, _schema_for(nested) if nested else T.StringType())
    return out


def json_scalar(json: Column, path: str) -> Column:
    """One scalar as text; NULL for missing fields, JSON null, objects, arrays and unreadable documents."""
    text = F.get_json_object(json, path)
    kind = F.schema_of_variant(F.try_variant_get(F.try_parse_json(json), path, "variant"))
    checked = F.when(kind.rlike("^(OBJECT|ARRAY)"), F.lit(None)).otherwise(text)
    return F.when(text.startswith("{") | text.startswith("["), checked).otherwise(text)


def json_query(json: Column, path: str) -> Column:
    """Sub-document as JSON text, NULL if missing or JSON null."""
    return F.get_json_object(json, path)


def json_array(json: Column, path: str) -> Column:
    """Elements of a JSON array, each as JSON text; NULL if there is no array."""
    return F.from_json(F.get_json_object(json, path), "array<string>")


def with_document(df: DataFrame, json: str, paths: Iterable[str], doc: str) -> DataFrame:
    """``df`` plus a struct column ``doc`` that holds the text at every path, parsed in one pass.

    The parsed document goes through a one-element explode. Conditions on its fields then stay above the parse; the
    planner would otherwise push them below and parse every document once per condition. A further column holds the
    document's variant form where some text looks like a container, and NULL elsewhere.
    """
    paths = list(dict.fromkeys(paths))
    schema = _schema_for([path_steps(path) for path in paths])
    parsed = df.select("*", F.explode(F.array(F.from_json(json, schema))).alias(doc))
    doubtful = " OR ".join(_container_like(_text_sql(doc, path)) for path in paths)
    return parsed.withColumn(_native(doc), F.expr(f"CASE WHEN {doubtful} THEN try_parse_json(`{json}`) END"))


def _native(doc: str) -> str:
    return f"{doc}_native"


# Expressions over a parsed document are SQL text: one call for each instead of a dozen Column calls for every field,
# which would take longer than running a small query.


def _text_sql(doc: str, path: str) -> str:
    return ".".join(f"`{step}`" for step in [doc, *path_steps(path)])


def _container_like(text: str) -> str:
    return f"(startswith({text}, '{{') OR startswith({text}, '['))"


def document_text(doc: str, path: str) -> Column:
    """Text at ``path`` of a parsed document; objects and arrays as JSON text."""
    return F.expr(_text_sql(doc, path))


def document_scalar(doc: str, path: str) -> Column:
    """Scalar at ``path`` of a parsed document; NULL for objects and arrays."""
    text, quoted = _text_sql(doc, path), path.replace("'", "\\'")
    kind = f"schema_of_variant(try_variant_get(`{_native(doc)}`, '{quoted}', 'variant'))"
    checked = f"CASE WHEN {kind} RLIKE '^(OBJECT|ARRAY)' THEN NULL ELSE {text} END"
    # nested branches, not AND: the planner would hoist common parts out of an AND and run them on every row
    return F.expr(f"CASE WHEN {_container_like(text)} THEN {checked} ELSE {text} END")


def extract_json(df: DataFrame, json: str, fields: Mapping[str, str], *keep: str | Column) -> DataFrame:
    """``keep`` columns plus one scalar text column per entry of ``fields`` (output name to path)."""
    parsed = with_document(df, json, fields.values(), "_doc")
    return parsed.select(*[document_scalar("_doc", path).alias(name) for name, path in fields.items()], *keep)


def explode_json_outer(df: DataFrame, json: str, path: str, name: str) -> DataFrame:
    """One row per element of the JSON array at ``path``; documents without elements keep one row with NULL."""
    return df.select("*", F.explode_outer(json_array(F.col(json), path)).alias(name))


def json_columns_to_string(df: DataFrame) -> DataFrame:
    """Turn every column holding native JSON (variant) into JSON text."""
    native = [f.name for f in df.schema.fields if isinstance(f.dataType, T.VariantType)]
    return df.withColumns({name: F.to_json(F.col(name)) for name in native}) if native else df

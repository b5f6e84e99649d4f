"""DQ7 from a JSON Schema document: its keywords compiled to column rules over VARIANT values.

``from_json`` gives NULL for a key that is missing, one that is null and one of
another type. A parsed VARIANT tells them apart, so each has a rule of its own:

* ``required:path``  the parent object lacks the key
* ``null:path``      the key is there and null, and its type does not allow that
* ``type:path``      the value has another type
* ``enum:path``, ``format:path`` (date-time), ``minimum:path``, ``maximum:path``,
  ``exclusiveMinimum:path``, ``exclusiveMaximum:path``, ``minLength:path``,
  ``maxLength:path``, ``pattern:path``  on values of the right type only

``malformed_json`` stands for text that is no JSON; the root's path is ``$``.
Understood: type (one or a list), properties, required and the keywords above; any
other keyword that would restrict values is an error, not ignored. A member of a
value that is no object is not looked at.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from devpulse.functions.predicates import reasons_array

_NOTES = {"$schema", "$id", "$comment", "title", "description", "default", "examples", "deprecated", "readOnly", "writeOnly"}
_KNOWN = {"type", "properties", "required", "enum", "format", "minimum", "maximum", "exclusiveMinimum", "exclusiveMaximum",
          "minLength", "maxLength", "pattern"}
# A date, a time with seconds, and an offset.
_DATE_TIME = r"^\d{4}-\d{2}-\d{2}[Tt]\d{2}:\d{2}:\d{2}(\.\d+)?([Zz]|[+-]\d{2}:\d{2})$"


def load_contract(spark: SparkSession, path: str) -> dict:
    """The schema document in a file on any path Spark reads."""
    return json.loads(spark.read.text(path, wholetext=True).first()[0])


def _kind(value: Column) -> Column:
    return F.schema_of_variant(value)


def _is(value: Column, name: str) -> Column:
    kind = _kind(value)
    number = (kind == "BIGINT") | kind.startswith("DECIMAL") | kind.isin("DOUBLE", "FLOAT")
    if name == "integer":  # 5.0 is one
        real = F.try_variant_get(value, "$", "double")
        return (kind == "BIGINT") | number & (F.floor(real) == real)
    if name == "number":
        return number
    if name == "string":
        return kind == "STRING"
    if name == "boolean":
        return kind == "BOOLEAN"
    if name == "object":
        return kind.startswith("OBJECT")
    if name == "array":
        return kind.startswith("ARRAY")
    if name == "null":
        return F.is_variant_null(value)
    raise ValueError(f"no JSON type {name!r}")


def _any(conditions: list[Column]) -> Column:
    out = conditions[0]
    for c in conditions[1:]:
        out = out | c
    return out


def compile_contract(schema: dict, value: Column, text: Column) -> list[tuple[str, Column]]:
    """(label, condition that a row breaks the rule) for every rule of the document, in its order.

    ``value`` is the parsed VARIANT, NULL for no JSON; rows without ``text`` are malformed.
    """
    rules = [("malformed_json", text.isNull() | value.isNull())]
    _compile(schema, value, "$", "", rules)
    return [(label, F.coalesce(broken, F.lit(False))) for label, broken in rules]


def _compile(schema: dict, value: Column, place: str, path: str, rules: list) -> None:
    unknown = set(schema) - _KNOWN - _NOTES
    if unknown:
        raise ValueError(f"{path or '$'}: keywords not understood: {sorted(unknown)}")
    name = path or "$"
    here = value if place == "$" else F.try_variant_get(value, place, "variant")
    kinds = schema.get("type", [])
    kinds = [kinds] if isinstance(kinds, str) else list(kinds)
    right = here.isNotNull() & _any([_is(here, k) for k in kinds]) if kinds else here.isNotNull()
    if kinds:
        if "null" not in kinds:
            rules.append((f"null:{name}", F.is_variant_null(here)))
        rules.append((f"type:{name}", here.isNotNull() & ~F.is_variant_null(here) & ~right))

    def on(broken: Column, *names: str) -> Column:
        """Broken by values of these types only."""
        return right & _any([_is(here, n) for n in names]) & broken

    number, string = F.try_variant_get(here, "$", "double"), F.try_variant_get(here, "$", "string")
    for word, broken in (("minimum", lambda x: number < x), ("maximum", lambda x: number > x),
                         ("exclusiveMinimum", lambda x: number <= x), ("exclusiveMaximum", lambda x: number >= x)):
        if word in schema:
            rules.append((f"{word}:{name}", on(broken(F.lit(float(schema[word]))), "number")))
    for word, broken in (("minLength", lambda x: F.char_length(string) < x), ("maxLength", lambda x: F.char_length(string) > x),
                         ("pattern", lambda x: ~string.rlike(x))):
        if word in schema:
            rules.append((f"{word}:{name}", on(broken(schema[word]), "string")))
    if "enum" in schema:
        strings = [v for v in schema["enum"] if isinstance(v, str)]
        if len(strings) != len(schema["enum"]):
            raise ValueError(f"{name}: enum of texts only")
        rules.append((f"enum:{name}", right & ~(_is(here, "string") & string.isin(*strings))))
    if "format" in schema:
        if schema["format"] != "date-time":
            raise ValueError(f"{name}: format {schema['format']!r} not understood")
        from devpulse.functions.time import parse_event_time_expr
        rules.append((f"format:{name}", on(~string.rlike(_DATE_TIME) | parse_event_time_expr(string).isNull(), "string")))
    members = schema.get("properties", {})
    is_object = here.isNotNull() & _is(here, "object")
    for key in [*members, *(k for k in schema.get("required", []) if k not in members)]:
        below = f"{path}.{key}" if path else key
        if "'" in key and '"' in key:
            raise ValueError(f"{below}: a VARIANT path cannot hold both quotes")
        at = f'{place}["{key}"]' if "'" in key else f"{place}['{key}']"
        if key in schema.get("required", []):
            rules.append((f"required:{below}", is_object & F.try_variant_get(value, at, "variant").isNull()))
        if key in members:
            _compile(members[key], value, at, below, rules)


def check_contract(df: DataFrame, schema: dict, text: str = "json_value") -> DataFrame:
    """The rows with ``contract_violations``: the labels of the rules that the JSON text breaks."""
    rules = compile_contract(schema, F.col("_variant"), F.col(text))
    return (df.withColumn("_variant", F.try_parse_json(F.col(text).cast("string")))
            .withColumn("contract_violations", reasons_array(rules)).drop("_variant"))


def contract_counts(df: DataFrame, schema: dict, text: str = "json_value") -> DataFrame:
    """``rule, row_count``: rows breaking each rule; one pass, rules nobody breaks are left out."""
    from devpulse.operators.quality import rule_counts
    parsed = df.select(F.col(text).cast("string").alias("_text")).withColumn("_variant", F.try_parse_json("_text"))
    return rule_counts(parsed, compile_contract(schema, F.col("_variant"), F.col("_text")))

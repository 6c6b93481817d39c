"""Structured extraction: schema checks, typed records, invoice fields, line items, rationales."""

from __future__ import annotations

import json
import re
from collections.abc import Mapping, Sequence
from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tutelage.functions.constants import INVOICE_SCHEMA
from tutelage.functions.jsontext import standard_and_sure
from tutelage.functions.text import norm_date, py_strip

_NUMBER = r"^(TINYINT|SMALLINT|INT|BIGINT|FLOAT|DOUBLE|DECIMAL)"
_SCALARS = {"string": "^STRING", "number": _NUMBER, "boolean": "^BOOLEAN", "null": "^VOID"}


#: Keywords that are checked, and those that state nothing to check.
CHECKED = {"type", "required", "properties", "items", "enum", "minimum", "maximum", "additionalProperties"}
NOTES = {"$schema", "$id", "$comment", "title", "description", "default", "examples"}


def _key(key: str) -> str:
    """A path to one key, whatever characters it has."""
    return "$['" + key.replace("\\", "\\\\").replace("'", "\\'") + "']"


def _named(at: Column, key: str) -> Column:
    return F.concat(at, F.lit(f".{key}" if re.fullmatch(r"\w+", key) else f"[{key!r}]"))


def _is_a(value: Column, kind: str | Sequence[str]) -> Column:
    if not isinstance(kind, str):
        return reduce(lambda a, b: a | b, [_is_a(value, k) for k in kind])
    if kind == "object":
        return F.try_variant_get(value, "$", "map<string,variant>").isNotNull()
    if kind == "array":
        return F.try_variant_get(value, "$", "array<variant>").isNotNull()
    if kind == "integer":
        number = F.try_variant_get(value, "$", "double")
        return F.schema_of_variant(value).rlike(_NUMBER) & F.coalesce(number == F.floor(number), F.lit(False))
    return F.schema_of_variant(value).rlike(_SCALARS[kind])


def violations(value: Column, schema: Mapping[str, Any], path: Column | None = None) -> Column:
    """What a variant breaks of a JSON Schema (types, required keys, array items), as texts."""
    unknown = set(schema) - CHECKED - NOTES
    if unknown or isinstance(schema.get("additionalProperties", False), Mapping):
        raise ValueError(f"schema keywords that are not checked: {', '.join(sorted(unknown)) or 'additionalProperties with a schema'}")
    here = F.lit("$") if path is None else path
    single, nested = [], []
    if "type" in schema:
        kinds = schema["type"] if isinstance(schema["type"], str) else " or ".join(schema["type"])
        single.append(F.when(~_is_a(value, schema["type"]), F.concat(here, F.lit(f": not {kinds}"))))
    if "enum" in schema:
        allowed = [F.to_json(value) == F.lit(json.dumps(v, separators=(",", ":"), ensure_ascii=False)) for v in schema["enum"]]
        single.append(F.when(~reduce(lambda a, b: a | b, allowed), F.concat(here, F.lit(": not in enum"))))
    number = F.try_variant_get(value, "$", "double")
    for keyword, wrong in (("minimum", number < schema.get("minimum", 0)), ("maximum", number > schema.get("maximum", 0))):
        if keyword in schema:
            single.append(F.when(_is_a(value, "number") & wrong, F.concat(here, F.lit(f": beyond {keyword}"))))
    if schema.get("additionalProperties", True) is False:
        keys = F.map_keys(F.try_variant_get(value, "$", "map<string,variant>"))
        extra = F.array_except(keys, F.array(*[F.lit(k) for k in schema.get("properties", {})]).cast("array<string>"))
        nested.append(F.transform(extra, lambda k: F.concat(here, F.lit("."), k, F.lit(": not allowed"))))
    for key in schema.get("required", ()):
        single.append(F.when(F.try_variant_get(value, _key(key), "variant").isNull(), F.concat(_named(here, key), F.lit(": missing"))))
    for key, sub in schema.get("properties", {}).items():
        part, at = F.try_variant_get(value, _key(key), "variant"), _named(here, key)
        if set(sub) - {"type"} - NOTES:
            nested.append(F.when(part.isNotNull(), violations(part, sub, at)))
        elif "type" in sub:
            kinds = sub["type"] if isinstance(sub["type"], str) else " or ".join(sub["type"])
            single.append(F.when(part.isNotNull() & ~_is_a(part, sub["type"]), F.concat(at, F.lit(f": not {kinds}"))))
    if "items" in schema:
        parts = F.try_variant_get(value, "$", "array<variant>")
        nested.append(F.flatten(F.transform(parts, lambda v, i: violations(
            v, schema["items"], F.concat(here, F.lit("["), i.cast("string"), F.lit("]"))))))
    none = F.array().cast("array<string>")
    return F.concat(F.array_compact(F.array(*single)) if single else none, *[F.coalesce(n, none) for n in nested])


def validate_json(df: DataFrame, col: str, schema: Mapping[str, Any] = INVOICE_SCHEMA, out: str = "violations") -> DataFrame:
    """Adds the list of violations of the JSON embedded in ``col``; an empty list means it conforms.

    The schema is read once on the driver and becomes part of the plan.
    """
    return _checked(df, col, schema, out).drop("__json")


def schema_rate(checked: DataFrame, col: str = "violations") -> DataFrame:
    """``(violation, n, share)`` over lists of violations: ``all`` rows, those that conform, and those with each kind of violation.

    Places in arrays are told apart no further (``[]``), nor are the keys that a schema does not allow, which come from the data. So the kinds are as
    few as the schema has; a row counts once for a kind.
    """
    kind = lambda v: F.when(v.endswith(": not allowed"), F.lit("additional key: not allowed")).otherwise(F.regexp_replace(v, r"\[\d+\]", "[]"))
    kinds = F.array_distinct(F.transform(col, kind))
    named = F.when(F.size(col) == 0, F.array(F.lit("conforms"))).otherwise(kinds)
    counts = checked.select(F.explode(F.concat(F.array(F.lit("all")), named)).alias("violation")).groupBy("violation").agg(F.count("*").alias("n"))
    total = F.max(F.when(F.col("violation") == "all", F.col("n"))).over(W.partitionBy(F.lit(0)))
    return counts.withColumn("share", F.col("n") / total)


def _checked(df: DataFrame, col: str, schema: Mapping[str, Any], out: str) -> DataFrame:
    """``validate_json`` that leaves the parsed text in ``__json``.

    Text and variant come out of a generator, behind which no filter or projection can write their expressions again: each text is
    parsed once, however often the checks look at it. A text that conforms for certain, as the Python pass that reads it sees, is not looked at again.
    """
    parsed = df.select("*", F.explode(F.array(standard_and_sure(schema)(F.col(col)))).alias("__p"))
    parsed = parsed.withColumn("__json", F.col("__p.json")).withColumn("__sure", F.col("__p.sure")).drop("__p")
    parsed = parsed.select("*", F.explode(F.array(F.when(~F.col("__sure"), F.try_parse_json("__json")))).alias("__v"))
    value = F.col("__v")
    checked = F.when(F.col("__sure"), F.array().cast("array<string>")).when(value.isNull(), F.array(F.lit("$: not JSON"))).otherwise(violations(value, schema))
    return parsed.select("*", F.explode(F.array(checked)).alias(out)).drop("__v", "__sure")


def schema_type(schema: Mapping[str, Any]) -> T.DataType:
    """The Spark type of a JSON Schema."""
    kind = schema.get("type", "string")
    if kind == "object":
        return T.StructType([T.StructField(k, schema_type(s)) for k, s in schema.get("properties", {}).items()])
    if kind == "array":
        return T.ArrayType(schema_type(schema.get("items", {})))
    return {"number": T.DoubleType(), "integer": T.LongType(), "boolean": T.BooleanType()}.get(kind, T.StringType())


def to_records(df: DataFrame, col: str, schema: Mapping[str, Any] = INVOICE_SCHEMA) -> DataFrame:
    """Rows whose JSON conforms, with the typed fields as columns."""
    good = _checked(df, col, schema, "__bad").filter(F.size("__bad") == 0)
    return (good.withColumn("__r", F.from_json(F.col("__json"), schema_type(schema)))
            .select("*", "__r.*").drop("__bad", "__json", "__r"))


# Where the invoice layouts put each field; the first that matches wins.
INVOICE_PATTERNS = {
    "invoice_number": (r"Invoice #(\S+)", r"Invoice No: *(\S+)", r"Ref: *(\S+)", r"Invoice text: *([^,\s]+)"),
    "invoice_date": (r"dated (\d{4}-\d{2}-\d{2})", r"Date: *(\d{1,2} [A-Za-z]{3} \d{4})", r"Date Issued: *(\d{2}/\d{2}/\d{4})",
                     r"date (\d{4}-\d{2}-\d{2})"),
    "vendor_name": (r"(?m)dated \S+ from (.+?)(?: Total:.*)?$", r"(?m)Seller: *(.+)$", r"(?m)Vendor: *(.+)$", r"vendor (.+?),"),
    "total_amount": (r"Total: [A-Z]{3} (\d+(?:\.\d+)?)", r"TOTAL \([A-Z]{3}\): (\d+(?:\.\d+)?)", r"Grand Total [A-Z]{3} (\d+(?:\.\d+)?)",
                     r"total [A-Z]{3} (\d+(?:\.\d+)?)"),
    "currency": (r"Total: ([A-Z]{3}) \d", r"TOTAL \(([A-Z]{3})\)", r"Grand Total ([A-Z]{3}) \d", r"total ([A-Z]{3}) \d"),
}
ITEM_PATTERN = r"(?m)^(?:\d+[).] )?(.+?) (?:x|qty )?(\d+) @ (?:[A-Z]{3} )?(\d+(?:\.\d+)?)(?: [A-Z]{3})?$"


def invoice_fields(text: Column) -> dict[str, Column]:
    """Raw text of each scalar field; null where no layout matches. Patterns are tried in turn, each at most once."""
    def first(patterns: Sequence[str]) -> Column:
        # The match is an array of one, so that the test for "nothing found" does not write the pattern a second time.
        found = [F.transform(F.array(F.regexp_extract(text, p, 1)), lambda x: F.when(x != "", x))[0] for p in patterns]
        return F.coalesce(*found)

    return {name: py_strip(first(patterns)) for name, patterns in INVOICE_PATTERNS.items()}


def invoice_items(text: Column) -> Column:
    """``array<struct<description, qty, unit_price, amount>>`` in text order, amount recomputed in decimals at the printed scale.

    Numbers beyond 19 digits are doubles; nothing overflows. The text is searched once, then only the lines found.
    """
    lines = F.regexp_extract_all(text, F.lit(ITEM_PATTERN), F.lit(0))
    group = lambda line, i: F.regexp_extract(line, ITEM_PATTERN, i)
    rows = F.transform(lines, lambda line: F.struct(group(line, 1).alias("d"), group(line, 2).alias("q"), group(line, 3).alias("u")))

    def item(r: Column) -> Column:
        qty = r["q"].try_cast("decimal(19,0)")
        price = r["u"].try_cast("decimal(19,6)")
        amount = F.try_multiply(qty, price)
        return F.struct(r["d"].alias("description"), F.coalesce(qty.cast("double"), r["q"].try_cast("double")).alias("qty"),
                        F.coalesce(price.cast("double"), r["u"].try_cast("double")).alias("unit_price"),
                        F.coalesce(amount.cast("double"), r["q"].try_cast("double") * r["u"].try_cast("double")).alias("amount"))

    return F.transform(rows, item)


def _once(df: DataFrame, fields: Mapping[str, Column], out: str) -> DataFrame:
    """``fields`` as one struct out of a generator, behind which no filter or projection writes their expressions again."""
    return df.select("*", F.explode(F.array(F.struct(*[c.alias(n) for n, c in fields.items()]))).alias(out))


def extract_invoice(df: DataFrame, text_col: str = "text") -> DataFrame:
    """Adds the schema's fields: strings, ISO date, number, items. Every text is searched once."""
    text = F.col(text_col)
    found = _once(df, {**invoice_fields(text), "line_items": invoice_items(text)}, "__i")
    raw = F.col("__i")
    return (found.withColumn("invoice_number", raw["invoice_number"])
            .withColumn("invoice_date", F.date_format(norm_date(raw["invoice_date"]), "yyyy-MM-dd"))
            .withColumn("vendor_name", raw["vendor_name"])
            .withColumn("total_amount", raw["total_amount"].cast("double"))
            .withColumn("currency", raw["currency"])
            .withColumn("line_items", raw["line_items"]).drop("__i"))


def invoice_json(fields: Sequence[str] = tuple(INVOICE_SCHEMA["properties"])) -> Column:
    """The extracted columns as the JSON text a model would be asked for."""
    return F.to_json(F.struct(*fields))


def line_items(df: DataFrame, text_col: str = "text", id_col: str = "id") -> DataFrame:
    """One row per invoice line, ``pos`` from 1."""
    return (df.select(id_col, F.posexplode(invoice_items(F.col(text_col))).alias("p", "item"))
            .select(id_col, (F.col("p") + 1).alias("pos"), "item.*"))


def reconcile(df: DataFrame, text_col: str = "text") -> DataFrame:
    """Adds ``items_total``, ``difference`` (stated minus items) and ``balanced``; all in the row, no shuffle."""
    money = lambda c: c.try_cast("decimal(18,2)")
    text = F.col(text_col)
    items = money(F.aggregate(invoice_items(text), F.lit(0).cast("decimal(38,6)"),
                              lambda acc, x: F.try_add(acc, x["amount"].try_cast("decimal(38,6)")).try_cast("decimal(38,6)")))
    found = _once(df, {"stated": money(invoice_fields(text)["total_amount"]), "items": items}, "__i")
    return (found.withColumn("stated_total", F.col("__i.stated")).withColumn("items_total", F.col("__i.items")).drop("__i")
            .withColumn("difference", F.col("stated_total") - F.col("items_total"))
            .withColumn("balanced", F.coalesce(F.col("difference") == 0, F.lit(False))))


def why_coverage(df: DataFrame, col: str = "output", fields: Sequence[str] = tuple(INVOICE_SCHEMA["properties"])) -> DataFrame:
    """Adds which of the extracted fields have a rationale under ``why`` and which do not. The text, and what stands under ``why``, is parsed once."""
    parsed = df.select("*", F.explode(F.array(F.from_json(F.col(col), "map<string,string>"))).alias("__o"))
    parsed = parsed.select("*", F.explode(F.array(F.from_json(F.col("__o")["why"], "map<string,string>"))).alias("__w"))
    present = F.filter(F.array(*[F.lit(f) for f in fields]), lambda f: F.coalesce(F.array_contains(F.map_keys("__o"), f), F.lit(False)))
    explained = F.coalesce(F.array_intersect(present, F.map_keys("__w")), F.array().cast("array<string>"))
    return parsed.withColumn("explained", explained).withColumn("unexplained", F.array_except(present, "explained")).drop("__o", "__w")


def pair_quality(df: DataFrame, schema: Mapping[str, Any] = INVOICE_SCHEMA) -> DataFrame:
    """Adds, for a preference pair, whether the sides differ, which of them conform, and the verdict. Where both are the same text it is parsed once."""
    differ = ~F.col("chosen").eqNullSafe(F.col("rejected"))
    other = df.withColumn("__other", F.when(differ, F.col("rejected")))
    checked = validate_json(validate_json(other, "chosen", schema, "__c"), "__other", schema, "__r").drop("__json", "__other")
    good_c = F.size("__c") == 0
    good_r = F.when(differ, F.size("__r") == 0).otherwise(good_c)
    verdict = (F.when(~differ, "same").when(good_c & ~good_r, "clear").when(good_c & good_r, "both conform")
               .when(~good_c & good_r, "inverted").otherwise("neither conforms"))
    return (checked.withColumn("differ", differ).withColumn("chosen_conforms", good_c)
            .withColumn("rejected_conforms", good_r).withColumn("verdict", verdict).drop("__c", "__r"))

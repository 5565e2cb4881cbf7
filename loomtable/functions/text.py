"""Column builders for text and maps of text. All are built-in expressions but the entity decoder and the URL resolver."""

from __future__ import annotations

import html
import json
from urllib.parse import urljoin

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: All 29 code points that Unicode counts as white space for stripping: Java's class and four separators it leaves out.
SPACE = r"[\s\x1c-\x1f]"
_EDGES = rf"(?U)^{SPACE}+|{SPACE}+$"
_RUNS = rf"(?U){SPACE}+"


@F.pandas_udf(T.StringType())
def _decode(x: pd.Series) -> pd.Series:
    return x.map(html.unescape, na_action="ignore")


@F.pandas_udf(T.ArrayType(T.StringType()))
def _decode_all(x: pd.Series) -> pd.Series:
    return x.map(lambda values: [None if v is None else html.unescape(v) for v in values], na_action="ignore")


def unescape(x: Column) -> Column:
    """HTML entities decoded once; a text without & never leaves the JVM's path of values."""
    return F.when(x.contains("&"), _decode(F.when(x.contains("&"), x))).otherwise(x)


def whole_references(x: Column) -> Column:
    """Text or HTML in which an & that begins no reference up to a semicolon stands as &amp;: decoding then keeps a reference that was cut (&amp, &quo) as it
    stands, where browsers and ``html.unescape`` take some names without their semicolon."""
    return F.regexp_replace(x, r"&(?!#?[0-9A-Za-z]+;)", "&amp;")


def squeeze(x: Column) -> Column:
    """Stripped, with each run of white space as one space."""
    return F.trim(F.regexp_replace(x, _RUNS, " "))


def strip(x: Column) -> Column:
    return F.regexp_replace(x, _EDGES, "")


def normal(x: Column) -> Column:
    """Entities decoded, then squeezed: the form in which titles and attributes are kept."""
    return squeeze(unescape(x))


def folded(x: Column) -> Column:
    """Stripped and in lower case: the form in which values are compared."""
    return F.lower(strip(x))


def normal_values(attributes: Column) -> Column:
    """A map's values in their normal form; keys and their order stay (T01, T02 on maps)."""
    values = F.map_values(attributes)
    decoded = F.when(F.exists(values, lambda v: v.contains("&")), _decode_all(values)).otherwise(values)
    squeezed = F.transform(decoded, squeeze)
    return F.when(attributes.isNull(), F.create_map().cast("map<string,string>")).otherwise(F.map_from_arrays(F.map_keys(attributes), squeezed))


def sorted_entries(attributes: Column) -> Column:
    """A map's entries in order of their keys' code points."""
    return F.array_sort(F.map_entries(attributes))


def content_key(title: Column, attributes: Column) -> Column:
    """Title and sorted key=value pairs, joined by | (T07); delimiters in values are not escaped."""
    return F.concat_ws("|", title, F.transform(sorted_entries(attributes), lambda e: F.concat(e["key"], F.lit("="), e["value"])))


def content_hash(title: Column, attributes: Column) -> Column:
    return F.sha2(content_key(title, attributes), 256)


def json_text(x: Column) -> Column:
    """A text as a JSON string literal; other than ASCII stays as it is."""
    return F.regexp_replace(F.to_json(F.array(x)), r"^\[|\]$", "")


def json_object(attributes: Column) -> Column:
    """A map of text as JSON with ", " and ": ", in the map's own order (T16): the form that models are trained on."""
    pairs = F.transform(F.map_entries(attributes), lambda e: F.concat(json_text(e["key"]), F.lit(": "), F.coalesce(json_text(e["value"]), F.lit("null"))))
    return F.concat(F.lit("{"), F.array_join(pairs, ", "), F.lit("}"))


def lookup(attributes: Column, key: str, default: str) -> Column:
    """A map's value, or the default where the key is absent; a null value stays null."""
    return F.when(F.map_contains_key(attributes, F.lit(key)), attributes[key]).otherwise(F.lit(default))


def title_line(title: Column) -> Column:
    """The user's text for a title; quotes in it are not escaped."""
    return F.concat(F.lit('Title: "'), F.coalesce(title, F.lit("")), F.lit('"'))


def title_line_once(text: Column) -> Column:
    """The same, unless the text has that form already."""
    return F.when(text.startswith('Title: "'), text).otherwise(title_line(text))


def basename(path: Column) -> Column:
    return F.substring_index(path, "/", -1)


def response_json(response: Column) -> Column:
    """The JSON text in a model's answer (T17): after the last </think>, inside a fence, from the first { to the last }.

    An answer without braces is returned as it is left, so that parsing it fails.
    """
    after = strip(F.substring_index(response, "</think>", -1))
    fence = F.regexp_extract(after, r"(?s)```(?:json)?(.*?)```", 1)
    inner = F.when(after.contains("```json"), F.get(F.split(F.get(F.split(after, "```json"), 1), "```"), 0)).when(
        after.contains("```"), F.get(F.split(after, "```"), 1)
    ).otherwise(after)
    inner = F.coalesce(strip(inner), fence)
    braces = F.regexp_extract(inner, r"(?s)\{.*\}", 0)
    return F.when(braces != "", braces).otherwise(inner)


def parsed_response(response: Column) -> Column:
    """The answer's object as a map of text; an empty map if it can't be parsed."""
    found = F.from_json(response_json(response), "map<string,string>")
    return F.coalesce(found, F.create_map().cast("map<string,string>"))


def data_uri(content: Column, kind: str = "jpeg") -> Column:
    """Bytes as a base64 data URI in one line."""
    return F.concat(F.lit(f"data:image/{kind};base64,"), F.translate(F.base64(content), "\r\n", ""))


def percent(x: Column) -> Column:
    """One decimal and a percent sign (T25), rounded as Python rounds: to the nearest by the number's exact binary value, ties to even.

    Twice the tenths of a percent are 20 times y = 100 x, which is 16 y + 4 y. Both are exact, and so is what their sum loses, so the sum and
    the loss together tell on which side of a half the number lies.
    """
    y = F.abs(x * F.lit(100.0))
    twice = y * 16 + y * 4
    loss = y * 4 - (twice - y * 16)
    tenths = F.floor(twice / 2)
    half = tenths * 2 + 1
    up = (twice > half) | ((twice == half) & ((loss > 0) | ((loss == 0) & (tenths % 2 == 1))))
    rounded = tenths + up.cast("long")
    text = F.concat(F.when(x < 0, "-").otherwise(""), F.floor(rounded / 10).cast("string"), F.lit("."), (rounded % 10).cast("string"), F.lit("%"))
    return F.when(y < 1e12, text).otherwise(F.format_string("%.1f%%", x * 100))


def utc_iso(ts: Column) -> Column:
    """ISO-8601 text of a timestamp in UTC."""
    return F.date_format(F.convert_timezone(None, F.lit("UTC"), ts.cast("timestamp_ntz")), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'+00:00'")


@F.pandas_udf(T.StringType())
def resolve_url(base: pd.Series, url: pd.Series) -> pd.Series:
    """A link as seen from its page (T13); null if either is."""
    return pd.Series([None if b is None or u is None else urljoin(b, u) for b, u in zip(base, url, strict=True)], dtype=object)


@F.pandas_udf(T.ArrayType(T.StringType()))
def python_texts(x: pd.Series) -> pd.Series:
    """JSON texts as Python prints their values (T04): True, None, 1.0, ['a']."""
    return x.map(lambda values: [str(json.loads(v)) for v in values], na_action="ignore")


def python_attributes(line: Column) -> Column:
    """Attributes of a listing's JSON text as Python would print them (T04): True, None, 1.0, ['a'].

    An opt-in for data whose nulls and booleans must read as before; the usual path takes a null as absent. Keys come
    in code point order, as VARIANT keeps them.
    """
    found = F.try_variant_get(F.try_parse_json(line), "$.attributes", "map<string,variant>")
    return F.map_from_arrays(F.map_keys(found), python_texts(F.transform(F.map_values(found), lambda v: F.coalesce(F.to_json(v), F.lit("null")))))

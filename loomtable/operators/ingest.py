"""From flat records to listings."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomtable.functions.text import python_texts


@dataclass(frozen=True)
class Mapping:
    """Which columns make a listing; without ``attribute_fields`` (target to source) all others are attributes."""

    title_field: str
    image_field: str | None = None
    attribute_fields: dict[str, str] | None = None
    url_field: str | None = None

    def reserved(self) -> set[str]:
        """Columns that are not attributes by default."""
        return {c for c in (self.title_field, self.image_field, self.url_field) if c}


def as_images(image: Column) -> Column:
    """One address as a list; none as an empty list."""
    return F.when(F.coalesce(image, F.lit("")) != "", F.array(image)).otherwise(F.array().cast("array<string>"))


def truthy(attributes: Column) -> Column:
    """Attributes with a value."""
    return F.map_filter(attributes, lambda k, v: v.isNotNull() & (v != ""))


def to_listings(records: DataFrame, mapping: Mapping, seq: str | None = None) -> DataFrame:
    """Listings of flat text records (P01 to P04): url, title, image_urls, attributes, and ``seq`` if named."""
    has = set(records.columns)
    text = lambda c: F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")) if c and c in has else F.lit("")
    if mapping.attribute_fields is None:
        pairs = [(c, c) for c in records.columns if c not in mapping.reserved() | {seq}]  # U04
    else:
        pairs = [(target, source) for target, source in mapping.attribute_fields.items() if source in has]
    made = F.create_map(*[x for t, s in pairs for x in (F.lit(t), F.col(f"`{s}`").cast("string"))]) if pairs else F.create_map().cast("map<string,string>")
    return records.select(
        *([F.col(seq).cast("long").alias("seq")] if seq else []),
        text(mapping.url_field).alias("url"),
        text(mapping.title_field).alias("title"),
        as_images(text(mapping.image_field)).alias("image_urls"),
        truthy(made).alias("attributes"),
    )


#: JSON texts of the values that count as no value: null, false, zero and what is empty.
FALSY = r'^(null|false|""|\[\]|\{\}|-?0(\.0*)?([eE][-+]?[0-9]+)?)$'
_TYPED = "url string, title string, image_urls variant, attributes map<string,variant>"


def _with_values(typed: Column, texts: Column) -> Column:
    """The entries of a typed map that have a value, as Python would print them; ``texts`` is the same map read as text."""
    kinds = F.transform(F.map_values(typed), lambda v: F.coalesce(F.to_json(v), F.lit("null")))
    raw = F.transform(F.map_values(texts), lambda v: F.coalesce(v, F.lit("null")))
    is_text = lambda k: k.startswith('"')
    as_json = F.zip_with(kinds, raw, lambda k, r: F.when(is_text(k), k).otherwise(r))
    printed = F.when(F.forall(kinds, is_text), raw).otherwise(python_texts(F.when(~F.forall(kinds, is_text), as_json)))
    entries = F.arrays_zip(F.map_keys(typed).alias("k"), kinds.alias("kind"), printed.alias("v"))
    backwards, n = F.reverse(F.map_keys(typed)), F.size(F.map_keys(typed))
    last = F.filter(entries, lambda e, i: F.array_position(backwards, e["k"]) == n - i)
    kept = F.filter(last, lambda e: ~e["kind"].rlike(FALSY))
    return F.map_from_entries(F.transform(kept, lambda e: F.struct(e["k"], e["v"])))


def typed_listings(lines: DataFrame, mapping: Mapping | None = None, value: str = "value", seq: str | None = None) -> DataFrame:
    """Listings of JSON lines whose values have types (P05, F05, T15): url, title, image_urls, attributes, and ``seq`` if named.

    A record whose attributes are an object is a listing already: one address instead of a list is wrapped, an empty one is
    none, and attributes that are null, false, zero or empty are left out, the others printed as Python prints them ("0" and
    " " are values). Any other record is flat and goes by ``mapping``; without one it has no attributes. Of repeated keys the last
    counts. A missing or null url or title is empty. Malformed lines fail.
    """
    none, bad = F.create_map().cast("map<string,string>"), F.raise_error(F.concat(F.lit("malformed record: "), F.col(value))).cast("string")
    line = F.when(F.json_object_keys(value).isNull(), bad).otherwise(F.col(value))
    whole = lines.select(
        *([F.col(seq).cast("long").alias("seq")] if seq else []), F.from_json(line, _TYPED).alias("r"), F.from_json(line, "attributes map<string,string>").alias("t"),
        F.from_json(line, "map<string,variant>").alias("f"), F.from_json(line, "map<string,string>").alias("ft"),
    )
    native = F.col("r.attributes").isNotNull()
    one, kind = F.try_variant_get("r.image_urls", "$", "string"), F.schema_of_variant("r.image_urls")
    images = F.when(kind == "STRING", as_images(one)).when(kind.startswith("ARRAY"), F.try_variant_get("r.image_urls", "$", "array<string>"))
    attributes = F.when(native, _with_values(F.col("r.attributes"), F.col("t.attributes")))
    flat_text = lambda c: F.coalesce(F.element_at("ft", c), F.lit("")) if c else F.lit("")
    if mapping is None:
        flat, url, title, image = none, F.coalesce("r.url", F.lit("")), F.coalesce("r.title", F.lit("")), F.array().cast("array<string>")
    else:
        values = _with_values(F.when(~native, F.col("f")), F.when(~native, F.col("ft")))
        if mapping.attribute_fields is None:
            flat = F.map_filter(values, lambda k, v: ~k.isin(*mapping.reserved()))
        else:
            pairs = F.array(*[F.struct(F.lit(t).alias("k"), F.element_at(values, s).alias("v")) for t, s in mapping.attribute_fields.items()])
            flat = F.map_from_entries(F.filter(pairs, lambda e: e["v"].isNotNull()))
        url, title, image = flat_text(mapping.url_field), flat_text(mapping.title_field), as_images(flat_text(mapping.image_field))
    return whole.select(
        *(["seq"] if seq else []), F.when(native, F.coalesce("r.url", F.lit(""))).otherwise(url).alias("url"), F.when(native, F.coalesce("r.title", F.lit(""))).otherwise(title).alias("title"),
        F.coalesce(F.when(native, images).otherwise(image), F.array().cast("array<string>")).alias("image_urls"), F.coalesce(attributes, flat, none).alias("attributes"),
    )


def native_listings(records: DataFrame) -> DataFrame:
    """Records that are listings already (P05): defaults filled in, attributes without a value dropped."""
    return records.select(
        *[c for c in ("seq",) if c in records.columns],
        F.coalesce("url", F.lit("")).alias("url"),
        F.coalesce("title", F.lit("")).alias("title"),
        F.coalesce("image_urls", F.array().cast("array<string>")).alias("image_urls"),
        truthy(F.coalesce("attributes", F.create_map().cast("map<string,string>"))).alias("attributes"),
    )

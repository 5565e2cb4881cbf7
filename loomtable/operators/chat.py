"""Chat records: from listings to training rows, and from stored rows back to title and truth."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomtable.functions import text as X
from loomtable.plans.schema import INSTRUCTION, Schema, system_prompt

_BLOCKS = "array<struct<type:string,text:string,image:string>>"


def truth(attributes: Column, schema: Schema) -> Column:
    """Only the schema's attributes, in the row's own order (P10)."""
    return F.map_filter(F.coalesce(attributes, F.create_map().cast("map<string,string>")), lambda k, v: k.isin(schema.names))


def first_image(image_urls: Column) -> Column:
    """First address, or null."""
    return F.when(F.get(image_urls, F.lit(0)) != "", F.get(image_urls, F.lit(0)))


def resolve_images(listings: DataFrame, files: DataFrame, image_dir: str) -> DataFrame:
    """``listings`` with image (J06): the first address if that file exists, else the file of that name in ``image_dir``
    if that exists, else the address. ``files`` (path) lists what exists; the planner broadcasts it if it is small."""
    have = files.select(F.col("path").alias("__p")).distinct()
    rows = listings.withColumn("__a", first_image(F.col("image_urls"))).withColumn("__b", F.concat(F.lit(image_dir.rstrip("/") + "/"), X.basename(F.col("__a"))))
    rows = rows.join(have.select(F.col("__p").alias("__x")), F.col("__a") == F.col("__x"), "left").join(
        have.select(F.col("__p").alias("__y")), F.col("__b") == F.col("__y"), "left"
    )
    return rows.withColumn("image", F.coalesce("__x", "__y", "__a")).drop("__a", "__b", "__x", "__y")


def messages(listings: DataFrame, schema: Schema, base: str = INSTRUCTION, *, text_only: bool = False, image: str | None = None) -> DataFrame:
    """``listings`` with messages (P11, P12): array of (role, content). content is text, or the JSON text of an image and
    a text block where the listing has an image. The system prompt is one literal."""
    picture = F.col(image) if image else first_image(F.col("image_urls"))
    said = X.title_line(F.col("title"))
    blocks = F.concat(
        F.lit('[{"type": "image", "image": '), X.json_text(picture), F.lit('}, {"type": "text", "text": '), X.json_text(said), F.lit("}]")
    )
    user = said if text_only else F.when(picture.isNotNull(), blocks).otherwise(said)
    turn = lambda role, content: F.struct(F.lit(role).alias("role"), content.alias("content"))
    return listings.withColumn(
        "messages",
        F.array(turn("system", F.lit(system_prompt(schema, base))), turn("user", user), turn("assistant", X.json_object(truth(F.col("attributes"), schema)))),
    )


def message_json(m: Column) -> Column:
    """A record as the line of a training file; content in block form stays an array."""
    one = lambda x: F.concat(
        F.lit('{"role": '), X.json_text(x["role"]), F.lit(', "content": '),
        F.when((x["role"] == "user") & x["content"].startswith('[{"type": '), x["content"]).otherwise(X.json_text(x["content"])), F.lit("}"),
    )
    return F.concat(F.lit('{"messages": ['), F.array_join(F.transform(m, one), ", "), F.lit("]}"))


def _blocks(content: Column) -> Column:
    return F.when(content.startswith("["), F.from_json(content, _BLOCKS))


def user_text(content: Column, *, last: bool = False) -> Column:
    """Text of a user's message: as it is, or of its first (or last) text block."""
    texts = F.filter(_blocks(content), lambda b: b["type"] == "text")
    pick = F.get(texts, F.size(texts) - 1) if last else F.get(texts, F.lit(0))
    return F.when(_blocks(content).isNotNull(), F.coalesce(pick["text"], F.lit(""))).otherwise(content)


def user_image(content: Column, *, last: bool = False) -> Column:
    """Image of a user's message, or null."""
    images = F.filter(_blocks(content), lambda b: b["type"] == "image")
    pick = F.get(images, F.size(images) - 1) if last else F.get(images, F.lit(0))
    return pick["image"]


def unify(rows: DataFrame) -> DataFrame:
    """Chat and raw rows with title and ground_truth (P06): a chat row's truth is its last message, its title the second
    message's text, its image is left out; raw rows keep theirs."""
    chat = F.size(F.coalesce("messages", F.array().cast(rows.schema["messages"].dataType))) > 0
    content = F.get("messages", F.lit(1))["content"]
    told = F.from_json(F.element_at("messages", -1)["content"], "map<string,string>")
    return rows.withColumn("__chat", chat).select(
        *[c for c in rows.columns if c not in ("title", "attributes", "image_urls")],
        F.when(F.col("__chat"), user_text(content)).otherwise(F.coalesce("title", F.lit(""))).alias("title"),
        F.when(F.col("__chat"), F.array().cast("array<string>")).otherwise(F.coalesce("image_urls", F.array().cast("array<string>"))).alias("image_urls"),
        F.when(F.col("__chat"), told).otherwise(F.coalesce("attributes", F.create_map().cast("map<string,string>"))).alias("ground_truth"),
    )


def prompts(rows: DataFrame, system: str, *, images: bool = True, last: bool = False) -> DataFrame:
    """Rows for a model (P07): system, text (wrapped once, T19) and image of chat or raw rows."""
    content = F.get("messages", F.lit(1))["content"]
    chat = F.size(F.coalesce("messages", F.array().cast(rows.schema["messages"].dataType))) > 0
    text = F.when(chat, user_text(content, last=last)).otherwise(F.coalesce("title", F.lit("")))
    image = F.when(chat, user_image(content, last=last)).otherwise(first_image(F.col("image_urls")))
    return rows.withColumn("system", F.lit(system)).withColumn("text", X.title_line_once(text)).withColumn("image", image if images else F.lit(None).cast("string"))


def with_images(rows: DataFrame, files: DataFrame, messages: str = "messages") -> DataFrame:
    """Chat rows whose image is among ``files`` (path), and those without an image."""
    rows = rows.withColumn("__i", user_image(F.get(messages, F.lit(1))["content"]))
    have = files.select(F.col("path").alias("__p")).distinct()
    return rows.join(have, F.col("__i") == F.col("__p"), "left").where("__i is null or __p is not null").drop("__i", "__p")

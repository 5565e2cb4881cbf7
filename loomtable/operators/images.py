"""Images of listings: addresses, hashes, manifests and, where Pillow is installed, pixels."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from io import BytesIO

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomtable.operators.clean import first_by
from loomtable.sources.committed import write_files

try:  # pixels need Pillow; all else works without
    from PIL import Image
except ImportError:
    Image = None


def of_listings(listings: DataFrame, seq: str = "seq") -> DataFrame:
    """seq, img_idx, image_url: one row for each image, numbered in its listing."""
    return listings.select(seq, F.posexplode("image_urls").alias("img_idx", "image_url"))


def is_image(content_type: Column) -> Column:
    """Whether a response may hold an image; no header passes."""
    kind = F.lower(F.coalesce(content_type, F.lit("")))
    return (kind == "") | kind.startswith("image/")


def content_sha(content: Column) -> Column:
    """Hex SHA-256 of bytes."""
    return F.sha2(content, 256)


def first_of_each(images: DataFrame, seq: str = "seq") -> DataFrame:
    """One image of each hash, the first by listing and place."""
    return first_by(images, ["hash"], [seq, "img_idx"])


def stored_path(root: str, seq: Column, img_idx: Column) -> Column:
    """root/listing/image.jpg."""
    return F.concat(F.lit(root.rstrip("/") + "/"), seq.cast("string"), F.lit("/"), img_idx.cast("string"), F.lit(".jpg"))


def manifests(listings: DataFrame, images: DataFrame, root: str, seq: str = "seq") -> DataFrame:
    """listing_id, local_paths, hashes of every listing, empty lists where it has no image left."""
    kept = images.withColumn("path", stored_path(root, F.col(seq), F.col("img_idx")))
    lists = kept.groupBy(seq).agg(F.array_sort(F.collect_list(F.struct("img_idx", "path", "hash"))).alias("x"))  # images of one listing
    none = F.array().cast("array<string>")
    return listings.select(seq).join(lists, seq, "left").select(
        F.col(seq).cast("string").alias("listing_id"),
        F.coalesce(F.transform("x", lambda e: e["path"]), none).alias("local_paths"),
        F.coalesce(F.transform("x", lambda e: e["hash"]), none).alias("hashes"),
    )


def stored(images: DataFrame, root: str, column: str = "jpeg") -> DataFrame:
    """Writes each image's bytes to its path under ``root`` (K09) and gives back the other columns of those written.

    All files appear or, where a task fails for good, none (``committed.write_files``). Rows without bytes are left out.
    """
    return write_files(images, root, column)


def download(listings: DataFrame, root: str, fetch: Callable[[str], tuple[str, bytes] | None], most: int = 1024, *, tasks: int = 8, raw: bool = False) -> DataFrame:
    """Images of listings to files, and their manifest (C07): fetch, hash, first of each hash, pixels over white (T22), JPEG.

    A failed or unreadable image is left out. ``raw`` writes bytes as they came, where Pillow is not at hand. Files are in place when
    this returns, and images are fetched once, whatever is done with the manifest.
    """
    got = first_of_each(fetched(of_listings(listings).repartition(tasks), fetch))
    got = got.withColumnRenamed("content", "jpeg") if raw else pixels(got, most, white=True).drop("content")
    files = stored(got.withColumn("path", stored_path(root, F.col("seq"), F.col("img_idx"))), root)
    return manifests(listings, files.select("seq", "img_idx", "hash"), root)


def totals(found: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Images in all (A13), and whether there is any (A14), of all manifests or of each group."""
    return found.groupBy(*by).agg(F.coalesce(F.sum(F.size("local_paths")), F.lit(0)).alias("images"), F.coalesce(F.bool_or(F.size("local_paths") > 0), F.lit(False)).alias("any_image"))


def fitted(width: Column, height: Column, most: int) -> Column:
    """Size after a proportional downscale to ``most`` on the longer side (T23), cut to whole pixels."""
    big = F.greatest(width, height)
    scale = F.when(big > most, F.lit(float(most)) / big).otherwise(1.0)
    return F.struct(F.floor(width * scale).cast("int").alias("width"), F.floor(height * scale).cast("int").alias("height"))


def _opened(content: bytes | None, most: int, white: bool) -> bytes | None:
    try:
        picture = Image.open(BytesIO(content))
        picture.seek(0)
        if white and picture.mode in ("RGBA", "LA", "PA"):
            over = Image.new("RGB", picture.size, (255, 255, 255))
            alpha = picture.convert("RGBA")
            over.paste(alpha, mask=alpha.getchannel("A"))
            picture = over
        picture = picture.convert("RGB")
        if max(picture.size) > most:
            scale = most / max(picture.size)
            picture = picture.resize((max(1, int(picture.width * scale)), max(1, int(picture.height * scale))), Image.LANCZOS)
        out = BytesIO()
        picture.save(out, "JPEG", quality=90)
        return out.getvalue()
    except Exception:  # noqa: BLE001  an unreadable image is null, whatever the codec says
        return None


def pixels(images: DataFrame, most: int = 1024, *, white: bool = False, content: str = "content") -> DataFrame:
    """``images`` with jpeg: RGB, first frame, downscaled (T21), transparency over white (T22); null if unreadable."""
    if Image is None:
        raise ImportError("pixels need Pillow")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            made = [_opened(x.as_py(), most, white) for x in b.column(b.schema.get_field_index(content))]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(made, pa.binary())], names=[*b.schema.names, "jpeg"])

    from pyspark.sql import types as T

    return images.mapInArrow(run, T.StructType([*images.schema.fields, T.StructField("jpeg", T.BinaryType())]))


def fetched(images: DataFrame, fetch: Callable[[str], tuple[str, bytes] | None], url: str = "image_url") -> DataFrame:
    """``images`` with content_type, content and hash of what ``fetch`` returns on the executors (S17); a failed or wrong
    one is left out."""
    from pyspark.sql import types as T

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            got = [fetch(u.as_py()) for u in b.column(b.schema.get_field_index(url))]
            more = [pa.array([g and g[0] for g in got], pa.string()), pa.array([g and g[1] for g in got], pa.binary())]
            yield pa.RecordBatch.from_arrays([*b.columns, *more], names=[*b.schema.names, "content_type", "content"])

    schema = T.StructType([*images.schema.fields, T.StructField("content_type", T.StringType()), T.StructField("content", T.BinaryType())])
    return images.mapInArrow(run, schema).where(F.col("content").isNotNull() & is_image(F.col("content_type"))).withColumn("hash", content_sha(F.col("content")))

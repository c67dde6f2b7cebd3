"""Pages of a file repository: query.pages[] with imageinfo and extmetadata maps."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from phyllo.functions.scalars import is_photo_title, plain_text
from phyllo.operators.ingest import given
from phyllo.sources.schemas import COMMONS_PAGE

#: Types of photographs. Fixed values.
PHOTO_TYPES = ["image/jpeg", "image/png", "image/webp"]


def files(pages: DataFrame, body: str = "body") -> DataFrame:
    """One row a file: the licence's address goes before its label, the thumbnail before the original."""
    rows = pages.select(F.inline(F.from_json(body, COMMONS_PAGE)["query"]["pages"]))
    info = F.get("imageinfo", F.lit(0))
    meta = lambda k: F.try_element_at(info["extmetadata"], F.lit(k))["value"]
    empty: Column = F.lit("")
    out = rows.select(
        F.concat(F.lit("commons:"), F.col("pageid").cast("string")).alias("source_id"), "title", info["mime"].alias("mime"), given(info["thumburl"], info["url"]).alias("image_url"), info["descriptionurl"].alias("original_url"),
        given(meta("LicenseUrl"), meta("LicenseShortName")).alias("license"), F.coalesce(plain_text(meta("Artist")), empty).alias("author"),
    )
    return out.where(F.col("mime").isin(*PHOTO_TYPES) & is_photo_title("title") & F.col("image_url").startswith("http")).dropDuplicates(["title"])

"""Small expressions over addresses, markup, log lines, groups and hashes."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Words of a title that is no photograph of a living plant. Fixed value, as a pattern.
NOT_A_PHOTO = r"\b(?:illustration|drawing|dessin|zeichnung|engraving|gravure|lithograph|botanical\s+plate|planche|k[öo]hler|flora\s+von|flora\s+of|herbarium|herbier|specimen|holotype|isotype|lectotype|type\s+sheet|distribution\s+map|carte|diagram|schema|logo|icon|stamp|timbre|coat\s+of\s+arms|chromolith)\b"
#: Entities in the order in which they are replaced. Fixed values.
ENTITIES = [("&amp;", "&"), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#039;", "'"), ("&nbsp;", " ")]
#: The format of collection logs: a counter, a name, and a failure with its reason. Fixed values.
LOG_FAILED = r"^\[\d+/\d+\]\s+(.+?):\s+(?:FAILED|ÉCHEC)\s+\(([A-Za-z_][\w.]*)[:)]"
LOG_SEEN = r"^\[\d+/\d+\]\s+(.+?):\s"


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _nullif_blank(c: Column) -> Column:
    return F.when(c != "", c)


def photo_id_of(url: Column | str) -> Column:
    return _nullif_blank(F.regexp_extract(_c(url), r"/photos/(\d+)/", 1))


def large_photo(url: Column | str) -> Column:
    return F.replace(_c(url), F.lit("/square."), F.lit("/large."))


def plain_text(html: Column | str, most: int = 200) -> Column:
    """Markup stripped, a few entities replaced in a fixed order, white space squeezed, cut after ``most`` characters."""
    s = F.regexp_replace(_c(html), "<[^>]+>", " ")
    for a, b in ENTITIES:
        s = F.replace(s, F.lit(a), F.lit(b))
    return F.substring(F.trim(F.regexp_replace(s, r"(?U)\s+", " ")), 1, most)


def is_photo_title(title: Column | str) -> Column:
    return ~_c(title).rlike("(?iu)" + NOT_A_PHOTO)


def failed_name(line: Column | str) -> Column:
    return _nullif_blank(F.regexp_extract(_c(line), LOG_FAILED, 1))


def failure(line: Column | str) -> Column:
    return _nullif_blank(F.regexp_extract(_c(line), LOG_FAILED, 2))


def seen_name(line: Column | str) -> Column:
    return _nullif_blank(F.regexp_extract(_c(line), LOG_SEEN, 1))


def group_key(source: Column | str, observation_id: Column | str, source_id: Column | str) -> Column:
    """The observation at its source, or the record itself where it belongs to none."""
    return F.concat(_c(source), F.lit(":"), F.coalesce(_nullif_blank(F.trim(_c(observation_id))), _c(source_id)))


#: Salt of the stable splits. Fixed value.
SALT = "flora-v1"


def split_fraction(group: Column | str, salt: str = SALT) -> Column:
    """A stable number of [0, 1] for a group, from the first 32 bits of a salted SHA-256."""
    return F.conv(F.substring(F.sha2(F.concat(F.lit(salt + ":"), _c(group)), 256), 1, 8), 16, 10).cast("long") / F.lit(4294967295.0)


def split_of(group: Column | str, train: float = 0.8, val: float = 0.1, salt: str = SALT) -> Column:
    f = split_fraction(group, salt)
    return F.when(f < train, "train").when(f < train + val, "val").otherwise("test")


def hamming(a: Column | str, b: Column | str) -> Column:
    return F.bit_count(_c(a).bitwiseXOR(_c(b)))


def hash_of_block(low: Column | str) -> Column:
    """The 64-bit hash of an 8 x 8 block of frequencies: bit i (highest first) is v[i] > median(v[1:])."""
    v = _c(low)
    rest = F.sort_array(F.slice(v, 2, 63))
    median = rest[31]
    return F.aggregate(v, F.lit(0).cast("long"), lambda acc, x: F.shiftleft(acc, 1).bitwiseOR(F.when(x > median, F.lit(1).cast("long")).otherwise(F.lit(0).cast("long"))))


def status_path(status: Column | str, path: Column | str) -> Column:
    """The path of a file under the folder of its status, whatever status it had before."""
    bare = F.regexp_replace(_c(path), "^(_rejected|_duplicates|_review)/", "")
    folder = F.create_map(*[F.lit(x) for x in ("rejected", "_rejected/", "duplicate", "_duplicates/", "review", "_review/")])
    return F.when(bare == "", bare).otherwise(F.concat(F.coalesce(F.try_element_at(folder, _c(status)), F.lit("")), bare))


def content_path(slug: Column, checksum: Column | str) -> Column:
    return F.concat(slug, F.lit("/"), F.substring(_c(checksum), 1, 16), F.lit(".jpg"))


def band_of(score: Column | str) -> Column:
    return F.when(_c(score) < 0.10, "silent").when(_c(score) < 0.70, "uncertain").otherwise("asserted")


def image_verdict(fmt: Column, frames: Column, width: Column, height: Column, least: int = 320, ratio: float = 12.0) -> Column:
    """Why an image is refused, the first rule that fails; null if it is admitted."""
    return (
        F.when(fmt.isNull(), "unreadable").when(~fmt.isin("JPEG", "PNG", "WEBP"), "format").when(frames > 1, "animated")
        .when(F.least(width, height) < least, "too small").when(F.greatest(width, height) > F.least(width, height) * ratio, "too narrow")
    )


def needs_rewrite(orientation: Column | str) -> Column:
    """Whether a picture is stored turned: its EXIF orientation is stated and not 1."""
    return F.coalesce(_c(orientation) != 1, F.lit(False))


def iso_instant(at: Column | str) -> Column:
    """An instant to the second as ISO 8601 in UTC; at ingest it is given F.current_timestamp() once."""
    return F.date_format(_c(at), "yyyy-MM-dd'T'HH:mm:ss'Z'")


def quoted(text: Column | str) -> Column:
    """A text as a literal of a query: between quotes, without any of its own."""
    return F.concat(F.lit('"'), F.replace(_c(text), F.lit('"'), F.lit("")), F.lit('"'))


def fitted_size(width: Column, height: Column, most: int = 384) -> Column:
    """struct(width, height) after shrinking the longer side to ``most``; a side is 1 at least."""
    scale = F.lit(float(most)) / F.greatest(width, height)
    side = lambda x: F.when(F.greatest(width, height) <= most, x).otherwise(F.greatest(F.lit(1), F.bround(x * scale)).cast("int"))
    return F.struct(side(width).alias("width"), side(height).alias("height"))

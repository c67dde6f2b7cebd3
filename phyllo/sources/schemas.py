"""Explicit schemas: nothing is inferred from data."""

from __future__ import annotations

from pyspark.sql import types as T

S, L, I = T.StringType(), T.LongType(), T.IntegerType()


def _struct(**kinds: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(n, k) for n, k in kinds.items()])


RECORD_TEXTS = [
    "species", "internal_plant_id", "source", "source_id", "original_url", "image_url", "author", "license", "license_url", "downloaded_at",
    "checksum", "path", "observation_id", "publisher", "dataset_key", "phash", "status", "reason", "duplicate_of",
]
RECORD = T.StructType([T.StructField(n, S) for n in RECORD_TEXTS] + [T.StructField("width", I), T.StructField("height", I), T.StructField("extra", T.MapType(S, S))])
PLANT_COLUMNS = ["internal_id", "scientific_name", "genus", "epithet", "family", "common_fr", "common_en", "common_de", "common_it", "synonyms", "gbif_key", "wikidata_id", "plantnet_id", "image"]
PLANT = T.StructType([T.StructField(n, S) for n in PLANT_COLUMNS])
SPLIT = _struct(path=S, species=S, internal_plant_id=S, split=S, group=S, captive=S)
MATCH = _struct(usageKey=L, acceptedUsageKey=L, scientificName=S, canonicalName=S, rank=S, status=S, matchType=S, family=S, genus=S, confidence=I)
GBIF_MEDIUM = _struct(type=S, format=S, references=S, created=S, creator=S, publisher=S, license=S, rightsHolder=S, identifier=S)
GBIF_OCCURRENCE = _struct(key=L, datasetKey=S, basisOfRecord=S, license=S, recordedBy=S, rightsHolder=S, references=S, publishingOrgKey=S, scientificName=S, media=T.ArrayType(GBIF_MEDIUM))
GBIF_PAGE = _struct(offset=I, limit=I, endOfRecords=T.BooleanType(), count=L, results=T.ArrayType(GBIF_OCCURRENCE))
COMMONS_INFO = _struct(mime=S, url=S, thumburl=S, descriptionurl=S, extmetadata=T.MapType(S, _struct(value=S)))
COMMONS_FILE = _struct(pageid=L, title=S, imageinfo=T.ArrayType(COMMONS_INFO))
COMMONS_PAGE = _struct(query=_struct(pages=T.ArrayType(COMMONS_FILE)))

"""Labels, identifiers, URLs, error texts and digests."""

from __future__ import annotations

import functools

from pyspark.sql import Column
from pyspark.sql import functions as F

HEALTH = r"workers=(\d+) cpu=([\d.]+)% mem=([\d.]+|nan)% backlog=(-?\d+)"


def tile_label(row: Column, col: Column) -> Column:
    return F.concat(F.lit("chunk_"), row.cast("string"), F.lit("_"), col.cast("string"))


def parsed_tile(label: Column) -> tuple[Column, Column]:
    """Row and column of a label (leading zeros allowed); nulls if it is none."""
    part = lambda k: F.regexp_extract(label, r"^chunk_(\d+)_(\d+)$", k).try_cast("int")
    return part(1), part(2)


def canonical_zone(zone: Column) -> Column:
    """' 7n' becomes '07N'; null for anything that is no zone."""
    found = F.upper(F.trim(zone))
    return F.when(found.rlike(r"^([1-9]|0[1-9]|[1-5]\d|60)[NS]$"), F.lpad(found, 3, "0"))


def baseline_number(text: Column) -> Column:
    """'05.1' and '5.10' are 510, '4' is 400; null unless one or two digits, then perhaps a point and one or two more."""
    form = r"^\s*([0-9]{1,2})(?:\.([0-9]{1,2}))?\s*$"
    part = lambda k: F.regexp_extract(text, form, k)
    return F.when(text.rlike(form), part(1).try_cast("int") * 100 + F.rpad(part(2), 2, "0").try_cast("int"))


def burst(title: Column) -> Column:
    """Burst identifier of a radar granule title; null if the title names none."""
    found = F.regexp_extract(title, r"_(T\d{3}-\d{6}-IW\d)_", 1)
    return F.nullif(found, F.lit(""))


def host(url: Column) -> Column:
    return F.nullif(F.lower(F.regexp_extract(url, r"^[a-zA-Z][a-zA-Z0-9+.-]*://([^/:?#]+)", 1)), F.lit(""))


def bucket(href: Column) -> Column:
    """Bucket of an object URL in scheme, virtual-host or path form."""
    scheme = F.regexp_extract(href, r"^s3://([^/]+)/", 1)
    virtual = F.regexp_extract(href, r"^https?://([^./]+)\.s3[.-][^/]*/", 1)
    path = F.regexp_extract(href, r"^https?://s3[.-][^/]*/([^/]+)/", 1)
    return F.coalesce(*[F.nullif(x, F.lit("")) for x in (scheme, virtual, path)])


def error_class(message: Column) -> Column:
    """Transient, absent, refused or other."""
    m = F.lower(message)
    return (
        F.when(m.rlike("timed? ?out|throttl|slow ?down|connection|50[0234]"), "transient")
        .when(m.rlike("not found|no such|404|missing"), "absent")
        .when(m.rlike("denied|forbidden|40[13]|refus"), "refused")
        .otherwise("other")
    )


#: Words of errors by what they say, and how errors name an HTTP status.
OWN_CREDENTIAL = ("ExpiredToken", "token has expired", "InvalidAccessKeyId", "SignatureDoesNotMatch")
REFUSAL = (
    "AccessDenied", "SlowDown", "ServiceUnavailable", "InternalError", "HTTP response code: 403", "HTTP response code: 500", "TooManyRequests", "Connection reset", "Broken pipe",
    "timed out", "Connection aborted", "RequestTimeout", "Could not resolve host", "Connection refused", "Empty reply from server", "handshake failed",
)
SOURCE_READER = ("RasterioIOError", "WarpOperationError", "CPLE_")
UNREADABLE = ("ZIPDecode", "TIFFReadEncodedTile")
MISSING_OBJECT = ("ObjectNotFound", "NoSuchKey", "HTTP response code: 410", "The specified key does not exist", "HTTP response code: 404")
HTTP_STATUS = r"(?:HTTP (?:response|error) code(?: on \S+| for \S+ range \S+)?:[ \t]+|response_code=)(\d{3})(?![\d/])"
TRANSIENT_STATUSES, ABSENT_STATUSES = (403, 408, 429), (404, 410)


def read_failure(text: Column) -> Column:
    """The one verdict on a failed read: own credential, refusal, wrong request, unreadable, absent, undecidable, in this order."""
    says = lambda words: functools.reduce(lambda a, b: a | b, [text.contains(w) for w in words])
    statuses = F.transform(F.regexp_extract_all(text, F.lit(HTTP_STATUS), 1), lambda s: s.cast("int"))
    wait = F.exists(statuses, lambda s: (s >= 500) | s.isin(*TRANSIENT_STATUSES))
    wrong = F.exists(statuses, lambda s: s.between(400, 499) & ~s.isin(*TRANSIENT_STATUSES, *ABSENT_STATUSES))
    refused = says(REFUSAL) | wait
    return (
        F.when(says(OWN_CREDENTIAL), "our-credential")
        .when(refused & says(SOURCE_READER), "provider-refused")
        .when(refused, "refusal-unattributed")
        .when(wrong, "client-error")
        .when(says(UNREADABLE), "unreadable")
        .when(says(MISSING_OBJECT) & says(SOURCE_READER), "absent")
        .otherwise("undecidable")
    )


def set_digest(values: Column) -> Column:
    """SHA-256 of the sorted distinct values joined by commas."""
    return F.sha2(F.concat_ws(",", F.array_sort(F.array_distinct(values))), 256)


def sorted_map(m: Column) -> Column:
    return F.map_from_entries(F.array_sort(F.map_entries(m)))

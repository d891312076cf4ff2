"""Feed times and corpus dates. Bad input gives null, never an error."""

from pyspark.sql import Column
from pyspark.sql import functions as F

# Zone names of RFC 822 as offsets.
ZONES = {
    "UT": "+0000", "UTC": "+0000", "GMT": "+0000", "Z": "+0000",
    "EST": "-0500", "EDT": "-0400", "CST": "-0600", "CDT": "-0500",
    "MST": "-0700", "MDT": "-0600", "PST": "-0800", "PDT": "-0700",
}
_RFC = [
    "d MMM yyyy HH:mm:ss Z", "d MMM yyyy HH:mm Z",
    "d MMM yy HH:mm:ss Z", "d MMM yy HH:mm Z",
]
_ISO = [
    "yyyy-MM-dd'T'HH:mm:ss[.SSSSSS][.SSS]XXX", "yyyy-MM-dd'T'HH:mm:ss[.SSSSSS][.SSS]XX",
    "yyyy-MM-dd'T'HH:mmXXX",
]


def feed_timestamp(c) -> Column:
    """RFC 822 or ISO 8601 time of a feed item."""
    bare = F.regexp_replace(F.trim(c), r"^[A-Za-z]{3,9}\.?,?\s+", "")
    zone = F.regexp_extract(bare, r"([A-Za-z]+)$", 1)
    offset = F.create_map(*[F.lit(x) for pair in ZONES.items() for x in pair])
    rfc = F.when(
        zone != "",
        F.concat(F.regexp_replace(bare, r"[A-Za-z]+$", ""),
                 F.coalesce(F.try_element_at(offset, F.upper(zone)), F.lit("?"))),
    ).otherwise(bare)
    tries = [F.try_to_timestamp(rfc, F.lit(p)) for p in _RFC]
    tries += [F.try_to_timestamp(F.trim(c), F.lit(p)) for p in _ISO]
    return F.coalesce(*tries)


def feed_date(c) -> Column:
    """``dd.MM.yyyy`` in UTC, an empty string when the time is absent or bad."""
    utc = F.to_utc_timestamp(feed_timestamp(c), F.current_timezone())
    return F.coalesce(F.date_format(utc, "dd.MM.yyyy"), F.lit(""))


def corpus_date(c) -> Column:
    return F.try_to_timestamp(c, F.lit("dd.MM.yyyy"))


def shard_stamp(ts) -> Column:
    """UTC name of an ingest run."""
    return F.date_format(F.to_utc_timestamp(ts, F.current_timezone()), "yyyy-MM-dd'T'HHmmss'Z'")

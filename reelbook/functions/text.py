"""Scalar column functions for names, paths, counts and times."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Every character Unicode text stripping removes; the last one is U+3000.
WHITESPACE = "".join(chr(code) for code in range(0x3001) if chr(code).isspace())

#: Fixed value: timestamp layout inside object names.
STAMP_FORMAT = "yyyyMMdd-HHmmss"

# First and last second of the years 1 and 9999, the range of ISO create times.
MIN_EPOCH = -62135596800
MAX_EPOCH = 253402300799


def strip(text: Column) -> Column:
    """Remove Unicode whitespace at both ends (plain ``trim`` removes spaces only)."""
    return F.btrim(text, F.lit(WHITESPACE))


def digits_of(text: Column) -> Column:
    """The ASCII digits of ``text``, everything else dropped."""
    return F.regexp_replace(text, "[^0-9]", "")


def digits_to_long(text: Column) -> Column:
    """Digits of ``text`` as a number: ``1,234`` is 1234 and ``115.2M`` is 1152.

    NULL if there is no digit, or if the number does not fit.
    """
    return digits_of(text).try_cast("bigint")


def grouped_to_long(text: Column) -> Column:
    """A whole number with underscores between its digits, as in ``1_700_000_000``; else NULL."""
    grouped = F.rlike(text, F.lit(r"^\s*[+-]?[0-9]+(?:_[0-9]+)+\s*$"))
    return F.when(grouped, F.replace(text, F.lit("_"), F.lit("")).try_cast("bigint"))


def url_username(url: Column) -> Column:
    """Text after the last ``@``, or the whole URL."""
    return F.substring_index(url, "@", -1)


def path_username(path: Column) -> Column:
    """Last folder of an object path; NULL if the path has no folder."""
    return F.try_element_at(F.split(path, "/"), F.lit(-2))


def stamp(ts: Column) -> Column:
    """``yyyyMMdd-HHmmss`` text of a timestamp."""
    return F.date_format(ts, STAMP_FORMAT)


def landing_path(username: Column, ts: Column) -> Column:
    """Object name of a raw page."""
    return F.concat(F.lit("profiles/"), username, F.lit("/"), stamp(ts), F.lit(".html"))


def processed_path(folder: str, username: Column, ts: Column) -> Column:
    """Object name of an extraction result; ``folder`` is ``profiles`` or ``videos``."""
    return F.concat(F.lit(f"{folder}/"), username, F.lit("/"), stamp(ts), F.lit(".json"))


def epoch_to_iso(seconds: Column) -> Column:
    """Epoch seconds as ``yyyy-MM-ddTHH:mm:ss``; NULL outside the years 1 to 9999."""
    return F.when(
        seconds.between(MIN_EPOCH, MAX_EPOCH),
        F.date_format(F.timestamp_seconds(seconds), "yyyy-MM-dd'T'HH:mm:ss"),
    )


def decode_payload(data: Column) -> Column:
    """Base64 message payload as text; NULL if it is not base64 of valid UTF-8."""
    return F.try_validate_utf8(F.try_to_binary(data, F.lit("base64")).cast("string"))

"""Titles, tags, words and links."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from hitparade import fixed


def words(text: Column, characters: str, min_length: int = fixed.WORD_MIN_LENGTH) -> Column:
    """Lower-case runs of the given characters, as an array, short runs left out."""
    return F.regexp_extract_all(F.lower(text), F.lit(f"{characters}{{{min_length},}}"), F.lit(0))


def tag_count(tags: Column, empty_as_zero: bool) -> Column:
    """Number of tags; text without tags counts as 1 in training data and as 0 in scoring requests."""
    counted = F.size(F.split(tags, r"\|"))
    missing = tags.isNull() | (tags == "") if empty_as_zero else tags.isNull()
    return F.when(missing, 0).otherwise(counted)


def or_default(text: Column, default: str) -> Column:
    """The text, or the default where it is null or empty."""
    return F.coalesce(F.nullif(text, F.lit("")), F.lit(default))


def watch_link(video_id: Column) -> Column:
    return F.concat(F.lit(fixed.WATCH_LINK), F.nullif(video_id, F.lit("")))


def link_video_id(url: Column) -> Column:
    """Video id in a short, watch or embed link; null for any other text."""
    origin = r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//"
    host = F.regexp_extract(url, origin + r"([^/?#]*)", 1)
    path = F.regexp_replace(F.regexp_extract(url, origin + r"[^/?#]*([^?#]*)", 1), r";[^/]*$", "")
    query = F.regexp_extract(url, r"^[^?#]*\?([^#]*)", 1)
    in_query = F.try_url_decode(F.regexp_extract(query, r"(?:^|&)v=([^&]+)", 1))
    embedded = F.when(path.startswith("/embed/"), F.substring_index(path, "/embed/", -1))
    found = F.when(host == fixed.SHORT_LINK_HOST, F.ltrim(path, F.lit("/"))).when(
        host.endswith(fixed.WATCH_HOST_SUFFIX),
        F.coalesce(F.nullif(in_query, F.lit("")), embedded),
    )
    return F.nullif(found, F.lit(""))

"""Identity of sources: ids of URLs and files, natural order, path codes, locales, permanent errors."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Suffixes of audio files.
AUDIO_SUFFIXES = (".m4a", ".webm", ".opus", ".ogg", ".oga", ".mp3", ".aac", ".flac", ".wav", ".mp4", ".mka")
#: Titles, in lower case, of listing entries that hold no video.
DEAD_TITLES = ("[private video]", "[deleted video]", "[unavailable video]")
#: Substrings, in lower case, of messages after which trying again is no use.
PERMANENT = (
    "private video",
    "members-only",
    "members only",
    "join this channel",
    "removed by the user",
    "removed by the uploader",
    "has been terminated",
    "video has been removed",
    "violat",
    "not available in your country",
    "blocked it on copyright grounds",
    "this live event will begin",
    "premieres in",
    "unable to extract video id",
    "is not a valid url",
    "unsupported url",
)


def url_id(url: Column, hosts: tuple[str, ...], short_hosts: tuple[str, ...]) -> Column:
    """Video id of a watch, short, embed, live or plain link on one of the hosts; null for anything else."""
    host = F.regexp_replace(F.regexp_replace(F.lower(F.try_parse_url(url, F.lit("HOST"))), r"^www\.", ""), r"^m\.", "")
    path = F.coalesce(F.try_parse_url(url, F.lit("PATH")), F.lit(""))
    blank = lambda c: F.nullif(c, F.lit(""))
    watch = F.when(path == "/watch", F.try_parse_url(url, F.lit("QUERY"), F.lit("v")))
    routed = F.regexp_extract(path, r"^/(?:shorts|embed|live|v)/([^/]+)", 1)
    return F.when(host.isin(*short_hosts), blank(F.regexp_extract(path, r"^/+([^/]+)", 1))).when(host.isin(*hosts), blank(F.coalesce(watch, routed)))


def is_local(spec: Column) -> Column:
    """Whether a source is a path or a file URL."""
    return spec.startswith("file://") | ~spec.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*://")


def local_id(path: Column) -> Column:
    """Id of a local file: its stem in safe characters, ``local`` if none remain."""
    stem = F.regexp_replace(F.regexp_replace(path, r"^.*/", ""), r"(?<=.)\.[^.]*$", "")
    safe = F.trim(F.regexp_replace(stem, r"[^0-9A-Za-z_-]+", "_"), F.lit("_"))
    return F.when(safe == "", "local").otherwise(safe)


def source_id(spec: Column, hosts: tuple[str, ...], short_hosts: tuple[str, ...]) -> Column:
    """Id of a URL or local path."""
    return F.when(is_local(spec), local_id(spec)).otherwise(url_id(spec, hosts, short_hosts))


def is_audio(path: Column) -> Column:
    """Whether the file name has an audio suffix."""
    return F.lower(path).rlike("(" + "|".join(s.replace(".", r"\.") for s in AUDIO_SUFFIXES) + ")$")


def natural_key(name: Column) -> Column:
    """Sort key that orders digit runs by value and other text without case.

    Digits are padded to 40 places and longer runs keep their length in front, so any run of digits compares right.
    """
    parts = F.regexp_extract_all(F.lower(name), F.lit(r"(\d+|\D+)"), 1)
    bare = lambda p: F.regexp_replace(p, r"^0+(?=\d)", "")
    padded = F.transform(parts, lambda p: F.when(p.rlike(r"^\d"), F.concat(F.lpad(F.char_length(bare(p)).cast("string"), 6, "0"), bare(p))).otherwise(p))
    return F.array_join(padded, "\x01")


def is_permanent_error(message: Column) -> Column:
    """Whether a failure is final."""
    return F.coalesce(F.lower(message).rlike("|".join(PERMANENT)), F.lit(False))


def short_locale(locale: Column) -> Column:
    """Language of a locale code."""
    return F.lower(F.substring_index(F.replace(locale, F.lit("_"), F.lit("-")), "-", 1))


def _stem(path: Column) -> Column:
    return F.regexp_replace(path, r"\.[^.]*$", "")


def path_code(path: Column, prefix: str) -> Column:
    """Object name of a clip, as FLAC below ``prefix``; ``path_decode`` undoes it."""
    return F.concat(F.lit(f"{prefix}/clips/"), _stem(path), F.lit(".flac"))


def path_decode(code: Column, prefix: str) -> Column:
    """Clip path, as WAV, of an object name."""
    return F.concat(_stem(F.substr(code, F.lit(len(f"{prefix}/clips/") + 1))), F.lit(".wav"))


def preferred_language(available: Column, patterns: list[str]) -> Column:
    """The first language that matches a pattern (equal or with ``*`` and ``?``), patterns in order of preference.

    Original-audio entries (``-orig``) never match.
    """
    offered = F.filter(available, lambda x: ~x.endswith("-orig"))
    like = lambda p: "^" + "".join(".*" if c == "*" else "." if c == "?" else ("\\" + c if c in r"\.[]{}()+-^$|" else c) for c in p) + "$"
    first = lambda p: F.get(F.filter(offered, lambda x: x.rlike(like(p))), 0)
    return F.coalesce(*map(first, patterns))

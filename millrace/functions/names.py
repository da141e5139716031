"""Names, sizes and text prefixes as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from millrace.functions.dimensions import INLINE


def is_url(source: Column) -> Column:
    return F.coalesce(source.rlike(r"(?i)^https?://"), F.lit(False))


def url_path(url: Column) -> Column:
    return F.regexp_extract(url, r"(?i)^https?://[^/?#]*([^?#]*)", 1)


def valid_url(url: Column) -> Column:
    """Whether a URL has a host of legal characters (or a bracketed address) and a port that exists, if any."""
    rest = F.regexp_extract(url, r"(?i)^https?:/+([^/?#\\]*)", 1)
    host = F.regexp_replace(rest, r"^.*@", "")
    port = F.nullif(F.regexp_extract(host, r":([0-9]*)$", 1), F.lit(""))
    shape = host.rlike(r"(?i)^([^\s@:<>\[\]^|%]+|\[[0-9a-f:.]+\])(:[0-9]*)?$")
    return F.coalesce(is_url(url) & shape & (F.coalesce(port.cast("decimal(38,0)"), F.lit(0)) <= 65535), F.lit(False))


def display_name(url: Column) -> Column:
    """Last segment of the path; query, fragment and trailing slashes don't count; none: ``document``."""
    return F.coalesce(F.nullif(F.regexp_extract(url_path(url), r"([^/]*)/*$", 1), F.lit("")), F.lit("document"))


def extension(name: Column) -> Column:
    """Lower case, with the dot; a leading dot alone does not count."""
    return F.lower(F.regexp_extract(name, r"^.+(\.[^.]*)$", 1))


def suffix(name: Column) -> Column:
    """Lower case from the last dot on, a leading one included."""
    return F.lower(F.regexp_extract(name, r"(\.[^.]*)$", 1))


def data_id(value: Column) -> Column:
    return F.nullif(F.substring(F.regexp_replace(value, r"[^A-Za-z0-9_.\-]", "_"), 1, 128), F.lit(""))


def dashed(value: Column) -> Column:
    """Runs of other characters become one dash, none at the ends. Every slug is a prefix of it."""
    return F.trim(F.regexp_replace(value, r"[^A-Za-z0-9._\-]+", "-"), F.lit("-"))


def slug(value: Column, size: int) -> Column:
    return F.substring(dashed(value), 1, size)


def run_name(value: Column) -> Column:
    return run_name_of(dashed(value))


def run_name_of(d: Column) -> Column:
    """``run_name`` from a ``dashed`` column."""
    return F.coalesce(F.nullif(F.substring(d, 1, 80), F.lit("")), F.lit("parse"))


def run_id(value: Column, ts: Column, tag: Column) -> Column:
    """Name, time and four hex digits of a run."""
    return F.concat_ws("_", run_name(value), stamp(ts), F.lower(F.substring(tag, 1, 4)))


def file_name(value: Column) -> Column:
    """Null where nothing usable is left."""
    return file_name_of(dashed(value))


def file_name_of(d: Column) -> Column:
    """``file_name`` from a ``dashed`` column."""
    s = F.substring(d, 1, 120)
    return F.when(~s.isin("", ".", ".."), s)


def entry_name(value: Column) -> Column:
    """An archive entry's relative name; null for absolute, drive, parent and empty names."""
    v = F.replace(value, F.lit("\\"), F.lit("/"))
    parts = F.filter(F.split(v, "/"), lambda x: ~x.isin("", "."))
    unsafe = v.rlike(r"^[A-Za-z]:|^/") | F.exists(parts, lambda x: x == "..") | (F.size(parts) == 0)
    return F.when(~unsafe, F.array_join(parts, "/"))


def is_directory(name: Column, external_attr: Column) -> Column:
    return name.endswith("/") | (external_attr.bitwiseAND(F.lit(0x10)) != 0)


def servable(rel: Column) -> Column:
    """Whether a relative artifact path may be served; either slash parts it."""
    rel = F.replace(rel, F.lit("\\"), F.lit("/"))
    return F.coalesce((rel != "") & ~rel.contains("..") & ~rel.startswith("/"), F.lit(False))


def size_parts(n: Column) -> tuple[Column, Column]:
    """(rounded number, unit) of a byte count."""
    n = n.cast("double")
    unit = F.when(n < 1024, "B").when(n < 1024**2, "KB").when(n < 1024**3, "MB").otherwise("GB")
    value = F.when(n < 1024, n).when(n < 1024**2, F.round(n / 1024, 1)).when(n < 1024**3, F.round(n / 1024**2, 1)).otherwise(F.round(n / 1024**3, 1))
    dead = n.isNull() | F.isnan(n) | (n <= 0)
    return F.when(dead, 0.0).otherwise(value), F.when(dead, "B").otherwise(unit)


def format_bytes(n: Column) -> Column:
    value, unit = size_parts(n)
    return F.concat(F.when(unit == "B", value.cast("long").cast("string")).otherwise(F.format_string("%.1f", value)), F.lit(" "), unit)


def kind(name: Column) -> Column:
    n = F.lower(name)
    return (
        F.when(n.endswith(".md"), "markdown").when(n.endswith(".json"), "json").when(n.endswith(".zip"), "zip")
        .when(n.rlike(r".(png|jpe?g|jp2|webp|gif|bmp)$"), "image").when(n.rlike(r"\.docx?$"), "docx").when(n.rlike(r"\.html?$"), "html")
        .when(n.rlike(r"\.(tex|latex)$"), "latex").otherwise("other")
    )


def inlineable(name: Column) -> Column:
    return suffix(name).isin(*INLINE)


def base_url(value: Column) -> Column:
    return F.regexp_replace(F.trim(value), "/+$", "")


def token(value: Column) -> Column:
    t = F.trim(value)
    return F.when(F.char_length(t).between(1, 4096), t)


def preview_prefix(text: Column, n: int) -> Column:
    """The first ``n`` bytes."""
    return F.substring(text.cast("binary"), 1, n)


def preview(text: Column, n: int) -> Column:
    """The longest prefix of whole characters within ``n`` bytes."""
    raw = preview_prefix(text, n)
    fixed = F.make_valid_utf8(raw.cast("string"))
    # A cut character turns into one mark at the end; marks of the text itself are whole and end on their last byte.
    whole = F.is_valid_utf8(raw.cast("string"))
    return F.when(whole, raw.cast("string")).otherwise(F.regexp_replace(fixed, "�$", ""))


#: What stands after a preview that was cut: a fixed value.
NOTICE = "\n...(预览已截断, 完整内容见 Artifact full.md)"


def preview_with_notice(text: Column, n: int) -> Column:
    """The preview, and a notice where it was cut; null texts are empty."""
    text = F.coalesce(text, F.lit(""))
    return F.when(truncated(text, n), F.concat(preview(text, n), F.lit(NOTICE))).otherwise(text)


def truncated(text: Column, n: int) -> Column:
    return F.octet_length(text) > n


def utc_day(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM-dd")


def stamp(ts: Column) -> Column:
    return F.date_format(ts, "yyyyMMdd-HHmmss")


def coded(value: Column) -> Column:
    """Percent-encoding of a URL's component: %20 for a space, and the marks ``!'()*~`` as they are."""
    out = F.replace(F.url_encode(value), F.lit("+"), F.lit("%20"))
    for mark in "!'()~":
        out = F.replace(out, F.lit(f"%{ord(mark):02X}"), F.lit(mark))
    return out


def merged(base: Column, extra: Column) -> Column:
    """Two maps of headers, the later one's values where both have a key; null maps are empty."""
    none = F.create_map().cast("map<string,string>")
    base, extra = F.coalesce(base, none), F.coalesce(extra, none)
    return F.map_concat(F.map_filter(base, lambda k, _: ~F.map_contains_key(extra, k)), extra)

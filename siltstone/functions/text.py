"""Scalar text functions as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

#: All Unicode white space and the four separators that Python strips too.
_WS = r"[\s\x1c-\x1f]"
#: The same, one by one.
_SPACES = "".join(map(chr, [*range(9, 14), *range(0x1C, 0x21), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]))
LINK = r"(?d)\[.*?\]\(.*?\)"
HAN = r"[\x{4e00}-\x{9fff}]"


def pinned(value: Column) -> Column:
    """`value`, made once for each row: keeps the optimizer from moving its making into a lambda that reads it."""
    return F.when(F.monotonically_increasing_id() >= 0, value)


def strip(x: Column) -> Column:
    """Without white space of any script at both ends; looks at the ends only, where a pattern would look at every place."""
    return F.btrim(x, F.lit(_SPACES))


def blank(x: Column) -> Column:
    return strip(x) == ""


def count_of(x: Column, pattern: str) -> Column:
    return F.size(F.regexp_extract_all(x, F.lit(f"({pattern})"), 1))


def clean_html(x: Column) -> Column:
    """Without tags, stripped; entities stay."""
    return strip(F.regexp_replace(x, r"<[^>]+>", ""))


def strip_html(x: Column) -> Column:
    """Without doctype, scripts and styles with their bodies, then without tags."""
    for pattern in (r"(?is)<!DOCTYPE[^>]*>", r"(?is)<script[^>]*>.*?</script>", r"(?is)<style[^>]*>.*?</style>", r"(?s)<[^>]+>"):
        x = F.regexp_replace(x, pattern, "")
    return x


def title_hash(title: Column) -> Column:
    """First 16 hex digits of the SHA-256 of the title without any white space."""
    return F.substring(F.sha2(F.regexp_replace(title, rf"(?U){_WS}+", ""), 256), 1, 16)


def canonical_url(url: Column, prefix: str | None = None, replace: tuple[str, str] | None = None) -> Column:
    """Relative URLs get `prefix` or become null; a domain is replaced; all from the first ?utm_ goes; numeric
    article paths of one outlet are completed."""
    out = F.when(url.startswith("http"), url).otherwise(F.concat(F.lit(prefix), url) if prefix else F.lit(None).cast("string"))
    if replace:
        out = F.replace(out, F.lit(replace[0]), F.lit(replace[1]))
    out = F.substring_index(out, "?utm_", 1)
    return F.regexp_replace(out, r"(storm\.mg)/(\d+)$", "$1/article/$2")


def domain_key(url: Column) -> Column:
    """Lower-cased authority, with user and port; empty if there is none."""
    return F.lower(F.coalesce(F.try_parse_url(url, F.lit("AUTHORITY")), F.lit("")))


def first_filled(*xs: Column) -> Column:
    """The first that is neither null nor empty, else empty."""
    return F.coalesce(*(F.nullif(x, F.lit("")) for x in xs), F.lit(""))


#: Patterns tried in order: with an offset or zone name, and without, for which the default offset holds.
WITH_ZONE = ("d MMM yyyy HH:mm:ss Z", "d MMM yyyy HH:mm:ss z", "yyyy-M-d'T'H:m:sXXX", "yyyy-M-d'T'H:m:s.SSSSSSXXX", "yyyy-M-d'T'H:m:s.SSSXXX", "yyyy-M-d'T'H:m:sxx")
WITHOUT_ZONE = ("yyyy-M-d H:m:s", "yyyy-M-d H:m", "yyyy/M/d H:m:s", "yyyy/M/d H:m", "yyyy-M-d")


def parse_time(x: Column, offset_hours: int = 8) -> Column:
    """An instant from any of the accepted formats; null if none fits. Zone names and -0000 count as what
    they say, times without a zone as of the fixed offset."""
    bare = F.regexp_replace(strip(x), r"^[A-Za-z]{3},\s*", "")
    zoned = [F.try_to_timestamp(bare, F.lit(p)) for p in WITH_ZONE]
    local = [F.try_to_timestamp(bare, F.lit(p)) - F.expr(f"INTERVAL {offset_hours} HOURS") for p in WITHOUT_ZONE]
    return F.coalesce(*zoned, *local)


def noon_bump(x: Column, raw: Column, offset_hours: int = 8) -> Column:
    """Noon of the day for dates that came without a time."""
    local = x + F.expr(f"INTERVAL {offset_hours} HOURS")
    return F.when((F.length(raw) <= 10) & (F.hour(local) == 0) & (F.minute(local) == 0), x + F.expr("INTERVAL 12 HOURS")).otherwise(x)


def entry_category(tag: Column, default: Column) -> Column:
    """The first tag if it is filled and of 20 characters at most."""
    return F.when((F.length(tag) > 0) & (F.length(tag) <= 20), tag).otherwise(default)

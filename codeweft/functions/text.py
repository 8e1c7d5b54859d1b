"""Text functions over source bytes, paths and repository URLs."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the line boundaries of str.splitlines.
LINE_BREAK = r"\r\n|[\n\r\x0B\x0C\x1C-\x1E\x{85}\x{2028}\x{2029}]"


def content_digest(content: Column) -> Column:
    return F.sha2(content, 256)


def is_utf8(content: Column) -> Column:
    """True where the bytes are valid UTF-8, so that decoding cannot fail."""
    return F.is_valid_utf8(content.cast("string"))


def decode_lossy(content: Column) -> Column:
    """Bytes to text, each bad byte sequence becoming U+FFFD."""
    return F.make_valid_utf8(content.cast("string"))


def line_count(text: Column) -> Column:
    """Number of lines; a break at the very end starts no new line."""
    closed = text.rlike(rf"(?:{LINE_BREAK})\z")
    parts = F.size(F.split(text, LINE_BREAK, -1))
    return (
        F.when(text == "", F.lit(0))
        .otherwise(parts - F.when(closed, F.lit(1)).otherwise(F.lit(0)))
        .cast("int")
    )


def relative_path(path: Column, root: str) -> Column:
    """Path below ``root`` with forward slashes and without a scheme."""
    plain = F.regexp_replace(F.replace(path, F.lit("\\"), F.lit("/")), r"^[a-z][a-z0-9]*:/+", "/")
    base = root.replace("\\", "/")
    if ":/" in base:
        base = "/" + base.split(":/", 1)[1].lstrip("/")
    base = base.rstrip("/") + "/"
    return F.when(F.startswith(plain, F.lit(base)), F.substring(plain, len(base) + 1, 1 << 30)).otherwise(plain)


def repo_id_from_url(url: Column, directory: Column) -> Column:
    """Owner and name of a hosted repository, else the folder's base name."""
    plain = F.replace(F.regexp_replace(F.coalesce(url, F.lit("")), r"\.git\z", ""), F.lit("\\"), F.lit("/"))
    hosted = F.regexp_extract(plain, r"(?s)^.*?github\.com[/: ]*(.*)\z", 1)
    base = F.regexp_extract(F.replace(directory, F.lit("\\"), F.lit("/")), r"([^/]*)/*\z", 1)
    return F.when(hosted != "", hosted).otherwise(base)


def keyed_record(line: Column) -> tuple[Column, Column]:
    """Key and value of a ``key<TAB>value`` line; the value may hold tabs."""
    parts = F.split(line, "\t", 2)
    return F.get(parts, F.lit(0)), F.get(parts, F.lit(1))


def after_last_colon(text: Column) -> Column:
    return F.substring_index(text, ":", -1)


def is_hex64(value: Column) -> Column:
    return F.coalesce(value.rlike(r"^[a-f0-9]{64}\z"), F.lit(False))

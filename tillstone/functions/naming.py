"""Names of tables, columns, sheets and files."""

from __future__ import annotations

from collections import Counter
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values.
BRONZE_PREFIX = "bronze_"
WAREHOUSE_NAME_LIMIT = 1024
UNNAMED_COLUMN = "unknown_column"
UNNAMED_TABLE = "unknown_table"


def quoted(name: str) -> str:
    """A column name that may hold dots, as a column reference."""
    return "`" + name.replace("`", "``") + "`"


def strip_scheme(path: Column) -> Column:
    """``file:///data/x`` and ``s3a://bucket/x`` as plain slash paths."""
    return F.regexp_replace(path, r"^[A-Za-z][A-Za-z0-9+.\-]*:/+", "/")


def source_path() -> Column:
    """Path of the file a row comes from, as listings give it: without scheme and percent codes."""
    return plain_path(F.col("_metadata.file_path"))


def plain_path(uri: Column) -> Column:
    """A URI without scheme and percent codes. It runs for every row, so only paths with codes meet a pattern."""
    first = F.locate("/", uri)
    has_scheme = (first > 2) & (F.substr(uri, first - 1, F.lit(1)) == ":")
    bare = F.when(has_scheme, F.concat(F.lit("/"), F.ltrim(F.substr(uri, first), F.lit("/")))).otherwise(uri)
    return F.when(uri.contains("%"), strip_scheme(F.url_decode(F.replace(uri, F.lit("+"), F.lit("%2B"))))).otherwise(bare)


def relative_path(path: Column, root: str) -> Column:
    """Path below ``root``, without scheme or leading slash."""
    plain_root = "/" + root.split(":", 1)[-1].strip("/") + "/"
    plain = strip_scheme(path)
    below = F.substr(plain, F.lit(len(plain_root) + 1))
    return F.when(plain.startswith(plain_root), below).otherwise(F.regexp_replace(plain, "^/+", ""))


def file_name(path: Column) -> Column:
    return F.element_at(F.split(path, "/"), -1)


def without_extension(name: Column) -> Column:
    return F.regexp_replace(name, r"^(.+)\.[^.]+$", "$1")


def bronze_table_name(relative: Column, depth: int = 3) -> Column:
    """Leading path parts joined by ``_``; deeper parts such as year and month are left out."""
    parts = F.slice(F.split(relative, "/"), 1, depth)
    return F.concat(F.lit(BRONZE_PREFIX), F.lower(F.array_join(parts, "_")))


def feature_name(relative: Column) -> Column:
    return F.element_at(F.split(relative, "/"), 1)


def warehouse_table_name(path: Column, prefix: str | None = None, max_length: int = WAREHOUSE_NAME_LIMIT) -> Column:
    """Folder names and the cleaned file stem joined by ``_``."""
    plain = F.regexp_replace(strip_scheme(path), "^/+", "")
    parts = F.filter(F.split(plain, "/"), lambda part: part != "")
    folders = F.transform(
        F.slice(parts, 1, F.greatest(F.size(parts) - 1, F.lit(0))),
        lambda part: without_extension(F.lower(part)),
    )
    stem = F.lower(without_extension(F.element_at(parts, -1)))
    cleaned = F.regexp_replace(stem, r"[^\p{L}\p{N}_]", "_")
    name = F.array_join(F.concat(folders, F.array(cleaned)), "_")
    if prefix:
        name = F.concat(F.lit(prefix + "_"), name)
    return F.coalesce(F.substring(name, 1, max_length), F.lit(UNNAMED_TABLE))


def safe_sheet_name(sheet: Column) -> Column:
    """Letters, digits, spaces, ``-`` and ``_`` only; then trimmed, spaces to ``_``."""
    kept = F.regexp_replace(sheet, r"[^\p{L}\p{N} _\-]", "")
    return F.translate(F.trim(kept), " ", "_")


def clean_headers(headers: Sequence[object]) -> list[str]:
    """Strip, spaces and dots to ``_``; every member of a repeated name gets a running number."""
    cleaned = [str(header).strip().replace(" ", "_").replace(".", "_") for header in headers]
    repeats = Counter(cleaned)
    seen: Counter[str] = Counter()
    result = []
    for name in cleaned:
        if repeats[name] == 1:
            result.append(name)
        else:
            result.append(f"{name}_{seen[name]}")
            seen[name] += 1
    return result


def standard_column_name(name: object) -> str:
    """Lower case with single underscores between words."""
    lowered = str(name).lower()
    for mark in " -.":
        lowered = lowered.replace(mark, "_")
    words = [word for word in lowered.split("_") if word]
    return "_".join(words) or UNNAMED_COLUMN

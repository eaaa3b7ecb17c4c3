"""Path text as column expressions."""

from __future__ import annotations

import os
import re

from pyspark.sql import Column
from pyspark.sql import functions as F

_SCHEME = r"^[A-Za-z][A-Za-z0-9+.-]+:(//[^/]*)?"


def clean_path(path: Column) -> Column:
    """Backslashes as slashes."""
    return F.translate(path, "\\", "/")


def parent_dir(path: Column) -> Column:
    """Everything before the last slash, empty for a bare name."""
    return F.when(path.contains("/"), F.regexp_replace(path, r"/[^/]*$", "")).otherwise("")


def join_path(root: str, path: Column) -> Column:
    return F.concat_ws("/", F.lit(root.rstrip("/")), path)


def path_segment(path: Column, position: int) -> Column:
    """The 0-based segment, null when the path is shorter."""
    return F.get(F.split(path, "/"), position)


def plain_root(root: str) -> str:
    """A root folder without scheme, host and trailing slash."""
    bare = re.sub(_SCHEME, "", root)
    return os.path.abspath(bare) if bare == root else bare.rstrip("/")


def relative_to(path: Column, root: str) -> Column:
    """A listed file's path below ``root``."""
    bare = F.regexp_replace(path, _SCHEME, "")
    return F.substr(bare, F.lit(len(plain_root(root)) + 2))


def is_safe_relative(path: Column) -> Column:
    """False for anything that could leave the target folder or name no file."""
    escapes = path.rlike(r"(^|/)\.\.(/|$)") | path.startswith("/") | path.rlike(r"^[A-Za-z]:")
    return path.isNotNull() & (path != "") & ~path.endswith("/") & ~escapes & ~path.contains("\0")


def checked_relative(path: Column) -> Column:
    """The path itself; an unsafe one fails the job."""
    shown = F.coalesce(path, F.lit("<null>"))
    return F.when(is_safe_relative(path), path).otherwise(
        F.raise_error(F.concat(F.lit("unsafe path in snapshot: "), shown))
    )

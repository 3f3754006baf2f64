"""Parts of a profile path ``centre/float/profiles/<mode><float>_<cycle>[D].nc``."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the path convention, with groups for float id and cycle. The
# first match anywhere in a path counts.
PROFILE_PATH_PATTERN = r"[a-z]*/[0-9]*/profiles/[A-Z]*([0-9]*)_([0-9]*)[A-Z]*.nc"


def profile_path(file: Column | str) -> Column:
    """The part of a path that follows the convention; null if none does.

    The functions below take such a path. Each names it once, so that a filter
    on one of them can be pushed down without repeating the work.
    """
    return F.nullif(F.regexp_extract(file, PROFILE_PATH_PATTERN, 0), F.lit(""))


def filepath_main(path: Column | str) -> Column:
    """``centre/float/``"""
    return F.concat(F.substring_index(path, "/", 2), F.lit("/"))


def filepath(path: Column | str) -> Column:
    """``centre/float/profiles/``"""
    return F.concat(F.substring_index(path, "/", 2), F.lit("/profiles/"))


def filename(path: Column | str) -> Column:
    return F.get(F.split(path, "/", 4), F.lit(3))


def wmoid(path: Column | str) -> Column:
    """Float id, from the file name; null if it has no digits."""
    return F.regexp_extract(path, PROFILE_PATH_PATTERN, 1).try_cast("int")


def cycle(path: Column | str) -> Column:
    """Cycle number, without leading zeros; null if the name has none."""
    return F.regexp_extract(path, PROFILE_PATH_PATTERN, 2).try_cast("int")


def float_filename(float_id: Column | str, suffix: str) -> Column:
    """Name of the file that holds every profile of a float."""
    float_id = F.col(float_id) if isinstance(float_id, str) else float_id
    return F.concat(float_id.cast("string"), F.lit(suffix))


def path_tail(path: Column | str, parts: int = 3) -> Column:
    """The last path parts: centre, float and file name by default."""
    return F.substring_index(path, "/", -parts)

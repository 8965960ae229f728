"""File-name timestamp functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from condmon.schemas import SNAPSHOT_TS_FORMAT


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def strip_extension(name) -> Column:
    """Drop the last dot-suffix like ``os.path.splitext``.

    Leading dots do not start a suffix (``.hidden`` stays), ``a..b`` gives
    ``a.``, a name without a dot is unchanged.
    """
    return F.regexp_replace(_c(name), r"^(\.*[^.].*)\.[^.]*$", "$1")


def published_timestamp(file) -> Column:
    """Timestamp text a producer publishes for a snapshot file name.

    The extension is stripped first; only a stem of exactly six dot-parts is
    reformatted to ``YYYY-MM-DD HH:MM:SS``.  A plain snapshot name
    ``2004.02.12.10.32.39`` therefore loses its seconds to the
    extension rule and is published as ``2004.02.12.10.32``.
    """
    stem = strip_extension(file)
    parts = F.split(stem, r"\.")
    reformatted = F.concat_ws(
        " ",
        F.concat_ws("-", F.slice(parts, 1, 3)),
        F.concat_ws(":", F.slice(parts, 4, 3)),
    )
    return F.when(F.size(parts) == 6, reformatted).otherwise(stem)


def snapshot_time(file) -> Column:
    """Typed time of a snapshot parsed from its file name, NULL on failure.

    The name is a wall-clock time without a zone, so the result is a
    ``TIMESTAMP_NTZ`` parsed without any zone (a session-zone parse would
    move a local time that falls in a DST gap).  ``to_timestamp_ntz`` raises
    on bad input under ANSI mode, so it only sees names that parse.
    """
    fmt = F.lit(SNAPSHOT_TS_FORMAT)
    return F.when(F.try_to_timestamp(_c(file), fmt).isNotNull(), F.to_timestamp_ntz(_c(file), fmt))

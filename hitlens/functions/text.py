"""String expressions used by the chart, resolution and enrichment jobs.

Every helper returns a ``Column`` built from ``pyspark.sql.functions`` so the
work stays inside whole-stage codegen; none of them is a Python UDF.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hitlens.constants import (  # noqa: F401 - NO_MATCH re-exported
    ARTIST_STOP_CHARACTER,
    DOUBLE_SPACE,
    FIELD_SEPARATOR,
    LABEL_SEPARATOR,
    MISSING,
    NO_MATCH,
    WORD_SEPARATOR,
)

ColumnOrName = Column | str


def _col(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def label(*parts: ColumnOrName) -> Column:
    """``a#b`` composite key.

    Uses ``concat`` (not ``concat_ws``) so that a null part makes the label
    null instead of silently disappearing; sources coalesce to ``''`` first.
    """
    cols: list[Column] = []
    for i, p in enumerate(parts):
        if i:
            cols.append(F.lit(LABEL_SEPARATOR))
        cols.append(_col(p))
    return F.concat(*cols)


def strip_commas(c: ColumnOrName) -> Column:
    """Remove every comma, so naive comma splitting downstream stays aligned."""
    return F.replace(_col(c), F.lit(FIELD_SEPARATOR), F.lit(""))


def normalise_artist(c: ColumnOrName) -> Column:
    """Lower-case, drop ``&``, then one non-recursive pass of double space -> space."""
    lowered = F.replace(F.lower(_col(c)), F.lit(ARTIST_STOP_CHARACTER), F.lit(""))
    return F.replace(lowered, F.lit(DOUBLE_SPACE), F.lit(WORD_SEPARATOR))


def blank_if_null(c: ColumnOrName) -> Column:
    """Optional attribute with the ``''`` default used throughout the data model."""
    return F.coalesce(_col(c), F.lit(MISSING))


def length_gap(a: ColumnOrName, b: ColumnOrName) -> Column:
    """``|len(a) - len(b)|`` in code points."""
    return F.abs(F.length(_col(a)) - F.length(_col(b)))


def parsed(df: DataFrame, name: str, kind: str) -> Column:
    """A column as a number; a text that isn't one fails the job whatever the session's ANSI setting."""
    c = F.col(name)
    if not isinstance(df.schema[name].dataType, T.StringType):
        return c.cast(kind)
    bad = F.raise_error(F.concat(F.lit(f"{name} is not a {kind}: "), c)).cast(kind)
    return F.when(c.isNotNull() & c.try_cast(kind).isNull(), bad).otherwise(c.try_cast(kind))


def split_words(c: ColumnOrName, keep_trailing: bool = True) -> Column:
    """Split a line on single spaces.

    ``keep_trailing=True`` keeps trailing empty words (split on ' ' with no
    limit). ``keep_trailing=False`` follows the JVM ``String.split`` rule:
    trailing empty words are dropped, an empty line still yields one empty
    word, and a line of only spaces yields none.
    """
    col = _col(c)
    if keep_trailing:
        return F.split(col, WORD_SEPARATOR, -1)
    trimmed = F.rtrim(col)
    return (
        F.when(col == F.lit(""), F.array(F.lit("")))
        .when(trimmed == F.lit(""), F.array().cast(T.ArrayType(T.StringType())))
        .otherwise(F.split(trimmed, WORD_SEPARATOR, -1))
    )


def text_equals(df: DataFrame, name: str, value: object) -> Column:
    """Compare a column with a literal in the column's own type.

    Ranking files are all text, derived tables carry ints. Comparing in the
    column's type keeps the predicate pushable into a Parquet scan and avoids
    casting every row.
    """
    dtype = df.schema[name].dataType
    if isinstance(dtype, T.StringType):
        return F.col(name) == F.lit(str(value))
    return F.col(name) == F.lit(value).cast(dtype)

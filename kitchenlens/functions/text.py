"""Scalar text functions, all native Spark expressions (no Python in the row path)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def col_of(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def title_case(c) -> Column:
    """Python ``str.title`` semantics: a letter following a non-letter is upper-cased, every other
    letter lower-cased (``O'Connor``, ``12Th``), unlike ``initcap`` which only looks at spaces.

    Written with ``transform`` over the character array: no Python, evaluated row by row in the JVM.
    """
    s = col_of(c)
    chars = F.split(s, "")

    def is_letter(ch: Column) -> Column:
        return F.upper(ch) != F.lower(ch)

    out = F.transform(
        chars,
        lambda ch, i: F.when((i == 0) | ~is_letter(F.element_at(chars, i)), F.upper(ch)).otherwise(F.lower(ch)),
    )
    return F.when(s.isNull(), F.lit(None).cast("string")).otherwise(F.array_join(out, ""))


def sanitise_action(value: str | None) -> str:
    """Column name of an action pivot value (null handled by the caller)."""
    return "num_" + value.lower().replace(" ", "_")


def sanitise_outcome(value: str | None) -> str:
    """Column name of a court-outcome pivot value: lower, space→_, drop '-', '__'→'_', drop '&_'."""
    return ("num_" + value.lower().replace(" ", "_").replace("-", "").replace("__", "_")
            .replace("&_", ""))


def parse_money(name: str) -> Column:
    """'1,234.50' → 1234.5; unparsable text → NULL (never an error under ANSI mode)."""
    return F.expr(f"try_cast(replace(`{name}`, ',', '') AS DOUBLE)")


def parse_int_text(name: str) -> Column:
    """'10,100' → 10100; unparsable → NULL."""
    return F.expr(f"try_cast(replace(`{name}`, ',', '') AS BIGINT)")


def hash_text(seed: int, columns) -> Column:
    """Seeded MD5 of the columns' texts as hex digits: evenly spread, and the same in every engine.

    NULL counts as a text of its own (an empty one counts as different)."""
    parts = [F.coalesce(F.concat(F.lit("="), F.col(c).cast("string")), F.lit("")) for c in columns]
    return F.md5(F.concat_ws("|", F.lit(str(seed)), *parts).cast("binary"))

"""One shape for everything that can go wrong with a record."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ERROR = "struct<error:string,schema:string,field:string,value:string,message:string>"
ERROR_FIELDS = ["error", "schema", "field", "value", "message"]


def error(name: str, message: Column | str, **parts: Column) -> Column:
    """An error entry; parts that do not apply stay NULL."""
    values = {
        "error": F.lit(name),
        "message": F.lit(message) if isinstance(message, str) else message,
        **parts,
    }
    return F.struct(
        *[values.get(f, F.lit(None)).cast("string").alias(f) for f in ERROR_FIELDS]
    )


def no_errors() -> Column:
    return F.array().cast(f"array<{ERROR}>")


def errors_where(*pairs: tuple[Column, Column]) -> Column:
    """Entries of the conditions that hold, in order."""
    return F.array_compact(F.array(*[F.when(condition, entry) for condition, entry in pairs]))


def settled(frame: DataFrame) -> DataFrame:
    """The same rows, computed once whatever is asked of them later.

    A filter on a computed column is pushed below the projection that computes it, which then runs for the
    filter and again for the result. No filter passes a generator, here one that gives each row back.
    """
    return frame.select(F.inline(F.array(F.struct(*frame.columns))))

"""Code-table slicing and decoding (capabilities C01-C03)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def code_slice(codes: DataFrame, namespace: str, code_alias: str, name_alias: str,
               code_name: str | None = None) -> DataFrame:
    """One enumeration of the shared code table, renamed for a join.

    ``code_name`` adds the second predicate some slices carry (keep one named constant).
    The literal predicates reach the parquet scan (or fold into an inline relation).
    """
    cond = F.col("namespace") == F.lit(namespace)
    if code_name is not None:
        cond = cond & (F.col("code_name") == F.lit(code_name))
    return codes.filter(cond).select(F.col("code").alias(code_alias), F.col("code_name").alias(name_alias))


def decode(df: DataFrame, codes: DataFrame, column: str, how: str = "inner") -> DataFrame:
    """Join ``df[column]`` to a code slice whose key column is also named ``column``.

    ``how="inner"`` drops rows whose code is unknown (or NULL); ``how="left"`` keeps them
    with a NULL name.  A code slice is a few inline rows of known size, so Spark chooses the
    map-side look-up by itself; a large code table would be joined by a shuffle.
    """
    if how not in ("inner", "left"):
        raise ValueError("decode joins are inner or left")
    return df.join(codes, on=column, how=how)


#: Fixed value: the characters after which INITCAP starts a word in the job's dialect.  The
#: apostrophe is none of them.
WORD_BREAKS = " \t\n\x0b\x0c\r!?@\"^#$&~_,.:;+-*%/|\\[](){}<>"


def initcap(text: Column) -> Column:
    """First letter of every word up, all others down; words end at ``WORD_BREAKS`` (the built-in
    function breaks at white space alone)."""
    after = "(?<=[" + "".join("\\" + c if c in "^-\\[]&" else c for c in WORD_BREAKS) + "])"
    return F.array_join(F.transform(F.split(F.lower(text), after),
                                    lambda w: F.concat(F.upper(F.left(w, F.lit(1))), F.substring(w, F.lit(2), F.length(w)))), "")


def label_normalize(name: Column) -> Column:
    """``SNAKE_CASE`` code name -> ``Title Case`` label (``IN_PROGRESS`` -> ``In Progress``)."""
    return initcap(F.replace(name, F.lit("_"), F.lit(" ")))

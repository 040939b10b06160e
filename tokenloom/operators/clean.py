"""Clean a generated text in one select chain (no UDF)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.text import (collapse_trim, drop_whitespace, space_after_punct,
                              split_prefix, strip_control, strip_escapes, strip_literal)


def clean_generated_col(text, prompt) -> Column:
    """Escapes removed from the whole text, the prompt-length prefix kept as is,
    the rest re-spaced, then control characters removed from everything.

    The cut uses the prompt's length after escape removal has already run on
    the text, so a prompt holding escapes shifts the cut (as in the original).
    """
    t = strip_escapes(strip_literal(text))
    context, gen = split_prefix(t, prompt)
    gen = collapse_trim(space_after_punct(drop_whitespace(gen)))
    return strip_control(F.concat(context, gen))


def clean_generated(df: DataFrame, text: str = "text", prompt: str = "prompt",
                    out: str = "cleaned") -> DataFrame:
    return df.withColumn(out, clean_generated_col(F.col(text), F.col(prompt)))

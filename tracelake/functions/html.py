"""HTML to text: entities are decoded first, then tags are removed."""

from __future__ import annotations

import html

import pandas as pd
from pyspark.sql import Column, functions as F, types as T

from tracelake.functions.text import col, strip


@F.pandas_udf(T.StringType())
def _decode_entities(values: pd.Series) -> pd.Series:
    return values.map(lambda v: html.unescape(v) if v else v)


def strip_html(c: Column | str) -> Column:
    """Decoded markup such as an escaped tag vanishes too; nothing replaces a tag."""
    text = F.coalesce(col(c), F.lit(""))
    # Python sees every row of the batch, so texts without an entity go over as nulls.
    decoded = F.coalesce(_decode_entities(F.when(F.contains(text, F.lit("&")), text)), text)
    return strip(F.regexp_replace(decoded, "<[^>]+>", ""))

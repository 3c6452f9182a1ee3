"""Labels once for each distinct text (OP-07, STR-6).

Reason and purpose texts repeat: a table of any size holds few of them. The many
LIKE patterns of a label then run once a text instead of once a row; the texts are
found by a partial aggregation, and the labels come back by one join, which Spark
broadcasts when it measures the dictionary as small and splits by rows when a text
is hot. Where nearly every row has a text of its own, label the rows directly.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def label_texts(df: DataFrame, text: str, labels: Mapping[str, Callable[[Column], Column]]) -> DataFrame:
    """``df`` with a column for each label, a function of the column ``text``
    alone. NULL is a text like any other; rows, repeated ones too, stay."""
    own = df.select(F.col(text).alias("_text")).distinct()
    known = own.select("_text", *[label(F.col("_text")).alias(name) for name, label in labels.items()])
    return df.join(known, F.col(text).eqNullSafe(F.col("_text")), "left").drop("_text")

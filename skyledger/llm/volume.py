"""How many buckets a text column needs, by its bytes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyledger.llm.common import partitions

#: Bytes of text for which there is one bucket, as long as there are few buckets; and beyond that.
SMALL, LARGE = 4 << 20, 64 << 20
#: So many small buckets at most: with more, what a piece of text sends to each becomes tiny.
FEW = 4096


def text_bytes(docs: DataFrame, text_col: str) -> int:
    """Bytes of all texts, in one pass without a shuffle."""
    return docs.agg(F.sum(F.octet_length(text_col).cast("bigint"))).first()[0] or 0


def buckets_for(docs: DataFrame, text_col: str) -> int:
    """Enough buckets that a task, which holds one at a time, needs tens of megabytes for it."""
    total = text_bytes(docs, text_col)
    return max(partitions(docs.sparkSession), min(FEW, -(-total // SMALL)), -(-total // LARGE))

"""Operator 7, token counts by compiled finite-state machines (see bpe.py).

Null texts are empty; an empty text has 0 tokens. A text of any length is read
whole, in chunks whose state maps compose by a prefix scan. Special strings in
a text are one token each, as the tokenizers library takes them by default.
Repeated rows are counted alike, other columns are ignored, an empty table
gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bpe
from . import kernels as K
from .shared import small_batches, table

MOST = 1024


def count_tokens(docs: DataFrame, vocabulary: str, most: int = MOST) -> DataFrame:
    """One row per document: bytes, tokens, and whether there are more than `most`. vocabulary: a file that executors can open."""

    small_batches(docs.sparkSession)

    def count(batches):
        machine = bpe.transducer(vocabulary)
        for batch in batches:
            column = K.text_column(batch).fill_null("")
            _, offs = K.utf8(column)
            for lo, hi in K.slices(offs):
                n = []
                for found in bpe.pieces(column.slice(lo, hi - lo).to_pylist(), machine.v.special):
                    special = [x for x in found if isinstance(x, str)] if machine.v.special else []
                    n.append(len(special) + machine.total([x for x in found if not isinstance(x, str)] if special else found))
                n = np.array(n, np.int64)
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(lo, hi - lo), pa.array(np.diff(offs[lo : hi + 1])), pa.array(n), pa.array(n > most)], names=["doc_id", "n_bytes", "n_tokens", "over_limit"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(count, "doc_id long, n_bytes long, n_tokens long, over_limit boolean")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return count_tokens(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))

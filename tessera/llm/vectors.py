"""Vector columns as numpy matrices, for the operators on embeddings."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F


def is_finite_vector(col: Column) -> Column:
    """Whether a vector is there and holds finite entries only."""
    entries = F.forall(col, lambda x: F.coalesce(F.abs(x.cast("double")) < float("inf"), F.lit(False)))
    return col.isNotNull() & F.coalesce(entries, F.lit(False))


def matrix(column: pa.ListArray, width: int) -> np.ndarray:
    """One row for each list, of ``width`` entries; what a list lacks is zero."""
    flat = column.flatten().to_numpy(zero_copy_only=False)
    lengths = column.value_lengths().to_numpy(zero_copy_only=False)
    if np.all(lengths == width):
        return flat.reshape(len(column), width)
    out = np.zeros((len(column), width), flat.dtype)
    rows = np.repeat(np.arange(len(column)), lengths)
    out[rows, np.arange(len(flat)) - np.repeat(np.cumsum(lengths) - lengths, lengths)] = flat
    return out

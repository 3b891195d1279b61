"""Which vectors take part in comparisons by cosine."""

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F


def comparable(embedding: str) -> Column:
    """True for a vector that is not null, holds only finite numbers and is not zero."""
    finite = F.forall(embedding, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(finite & F.exists(embedding, lambda x: x != 0), F.lit(False))


def matrix(vectors: pd.Series) -> np.ndarray:
    """The vectors of equal length as rows in double precision."""
    return np.stack(vectors.tolist()).astype(np.float64) if len(vectors) else np.zeros((0, 0))


def pair_cosines(x: np.ndarray, a: np.ndarray, y: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Cosine of x[a[i]] and y[b[i]] for all i, in blocks of bounded memory. Rows are scaled by their greatest entry
    first, so no square over- or underflows."""
    x, y = (m / np.abs(m).max(axis=1, keepdims=True) for m in (x, y))
    x_norm, y_norm = np.sqrt(np.einsum("ij,ij->i", x, x)), np.sqrt(np.einsum("ij,ij->i", y, y))
    out = np.empty(len(a))
    step = max(1, (1 << 22) // max(1, x.shape[1]))
    for i in range(0, len(a), step):
        p, q = a[i : i + step], b[i : i + step]
        out[i : i + step] = np.einsum("ij,ij->i", x[p], y[q]) / (x_norm[p] * y_norm[q])
    return out


def unit(x: np.ndarray) -> np.ndarray:
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.linalg.norm(x, axis=1, keepdims=True)

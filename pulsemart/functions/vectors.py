"""Vector similarity."""

from __future__ import annotations

from collections.abc import Callable, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, functions as F


def dot(a: Column, b: Column) -> Column:
    products = F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double"))
    return F.aggregate(products, F.lit(0.0), lambda total, x: total + x)


def unit(v: Column) -> Column:
    """The vector at length 1; one without length stays as it is."""
    length = F.greatest(F.sqrt(dot(v, v)), F.lit(1e-12))
    # As a field of a one-element array the length is computed once, not per number.
    return F.flatten(F.transform(F.array(length), lambda n: F.transform(v, lambda x: x.cast("double") / n)))


def similarity_to(asked: Sequence[float] | None) -> Callable[[Column], Column]:
    """Cosine similarity with one vector, batch by batch.

    Null for missing vectors, vectors of another size, and vectors without length.
    """
    wanted = np.asarray(asked if asked is not None else [], "float64")
    length = np.linalg.norm(wanted)
    wanted = wanted / length if length else wanted[:0]

    @F.pandas_udf("double")
    def compare(vectors: pd.Series) -> pd.Series:
        out = np.full(len(vectors), np.nan)
        usable = np.array([v is not None and len(v) == len(wanted) > 0 for v in vectors], bool)
        if usable.any():
            grid = np.stack(vectors[usable].to_numpy()).astype("float64")
            sizes = np.linalg.norm(grid, axis=1)
            out[usable] = np.divide(grid @ wanted, sizes, out=np.full(len(grid), np.nan), where=sizes > 0)
        return pd.Series(out)

    return compare

"""Rotation of best fit from accumulated 3x3 covariances."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql import types as T

ROTATION_TYPE = T.StructType(
    [
        T.StructField("rotation", T.ArrayType(T.DoubleType())),
        T.StructField("strength", T.DoubleType()),
        T.StructField("second", T.DoubleType()),
    ]
)


def rotations(batch: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row-major rotation, strength and middle singular value of each covariance."""
    left, values, right = np.linalg.svd(batch)
    mirrored = np.linalg.det(left @ right) < 0.0
    right[mirrored, 2, :] *= -1.0
    rotation = np.transpose(left @ right, (0, 2, 1)).reshape(-1, 9)
    return rotation, values.sum(axis=1), values[:, 1]


@F.pandas_udf(ROTATION_TYPE)
def best_rotation(covariance: pd.Series) -> pd.DataFrame:
    """Proper rotation maximizing agreement, for a batch of row-major covariances.

    ``strength`` is the sum of singular values, ``second`` the middle one; the
    covariance is source-by-target, and the rotation acts on column vectors.
    """
    rotation, strength, second = rotations(np.stack(covariance.to_numpy()).astype(float).reshape(-1, 3, 3))
    return pd.DataFrame({"rotation": list(rotation), "strength": strength, "second": second})

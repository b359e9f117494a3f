"""What the operators on vectors share."""

import numpy as np
from pyspark.sql import functions as F


def usable(vectors, key="vec_id", vector="embedding"):
    """Rows whose vector is not null, not zero and has only finite components; those of others take no part."""
    v = F.col(f"`{vector}`")
    # Not a number compares as larger than any number.
    finite = F.forall(v, lambda x: x.isNotNull() & (F.abs(x) < float("inf")))
    return vectors.where(v.isNotNull() & F.col(f"`{key}`").isNotNull() & finite & F.exists(v, lambda x: x != 0))


def matrix(array, dimension):
    """An Arrow list array without nulls, all lists of one length, as a matrix of 64-bit floats."""
    return np.asarray(array.flatten(), dtype="f8").reshape(len(array), dimension)


def rotation(dimension, seed):
    """A random rotation: the orthogonal factor of a Gaussian matrix, signs fixed so that it is uniform."""
    q, r = np.linalg.qr(np.random.default_rng(seed).standard_normal((dimension, dimension)))
    return q * np.sign(np.diag(r))

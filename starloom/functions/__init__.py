from .hashing import bucket52, threshold
from .vectors import as_double_vector, cosine, dot

__all__ = ["as_double_vector", "bucket52", "cosine", "dot", "threshold"]

"""Collaborative filtering on rating tables as Spark DataFrame operators."""

from .plans.model import FactorModel
from .recommender import Recommender
from .schemas import Columns

__all__ = ["Columns", "FactorModel", "Recommender"]

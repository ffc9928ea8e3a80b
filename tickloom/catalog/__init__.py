"""Named queries over the provided tables, each with its SQL twin where SQL can say it."""

from tickloom.catalog.oracles import ORACLES
from tickloom.catalog.queries import QUERIES

__all__ = ["ORACLES", "QUERIES"]

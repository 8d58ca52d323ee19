"""All queries of the library by name, with their SQL."""

from . import derive, large, lexical, relational, repairs, sequences, typed, udfs  # noqa: F401
from .base import QUERIES, SQL  # noqa: F401

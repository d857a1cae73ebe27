"""Analytics over large directed follow graphs, as Spark DataFrame jobs."""

from edgeloom.operators import *  # noqa: F401,F403
from edgeloom.operators import __all__ as _operators
from edgeloom.sources import *  # noqa: F401,F403
from edgeloom.sources import __all__ as _sources

__all__ = [*_operators, *_sources]

"""The registered queries: each runs an operator over the given tables.

``text``, ``mail``, ``scrub``, ``qa``, ``tabular``, ``state`` and ``files`` each fill the
shared registry with Spark queries and, where SQL can say the same, the SQL to check them.
"""

from registered import files, mail, qa, scrub, state, tabular, text  # noqa: F401
from registered.base import QUERIES, SQL

__all__ = ["QUERIES", "SQL"]

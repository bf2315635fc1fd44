"""DuckDB SQL oracle: an independent SQL formulation of every registered query.

``ctes`` holds named SQL building blocks (adapter views, then pipeline
stages); ``sql_for(final, deps)`` prefixes the needed blocks as a WITH list.
"""

from .ctes import CTE, sql_for  # noqa: F401

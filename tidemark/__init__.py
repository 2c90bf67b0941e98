"""Layered (bronze -> silver -> gold) retail analytics on open-source Spark.

Every operator is a function from DataFrames to a DataFrame.  Time enters only
through arguments (``as_of``), so results are repeatable.
"""

from tidemark.session import (
    build_session,
    configure_aqe,
    scratch_path,
    size_shuffles,
    use_disk_state,
)

__all__ = ["build_session", "configure_aqe", "scratch_path", "size_shuffles", "use_disk_state"]

"""Star-schema warehouse operators for PySpark.

Everything here is a lazy ``DataFrame -> DataFrame`` function; only the sinks
and the streaming jobs run Spark actions.
"""

from starloom.session import get_session, scratch_dir

__all__ = ["get_session", "scratch_dir"]

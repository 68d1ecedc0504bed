"""formsieve: a PySpark engine for cleaning, correcting and aggregating form-based survey data.

Every operator takes and returns a ``DataFrame`` and is built from native column
expressions, joins, aggregates and windows, so Catalyst plans all of it.
"""

from formsieve.session import get_session, materialize

__all__ = ["get_session", "materialize"]

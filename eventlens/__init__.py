"""eventlens: event-stream analytics as Spark DataFrame operators.

Every operator takes and returns a DataFrame. Batch forms are pure
DataFrame/SQL compositions that Catalyst plans; streaming forms live in
``eventlens.streaming``.
"""

from eventlens.session import get_session, checkpoint_dir

__all__ = ["get_session", "checkpoint_dir"]

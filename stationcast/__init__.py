"""stationcast: station downscaling analytics as Spark DataFrame operators.

Every operator takes and returns a lazy ``DataFrame``; nothing is collected
on the driver except bounded results (model coefficients, fold tables,
boosting leaf values).  Long form ``(keys..., date, point|member, value)``
is the canonical layout; wide tables are built only at model entry.
"""

from stationcast.session import get_session, checkpoint_dir, read_table

__all__ = ["get_session", "checkpoint_dir", "read_table"]

"""flightlake: aircraft-state and airport feeds as Spark DataFrame jobs.

Every transform is ``DataFrame -> DataFrame`` so the same code runs in a
batch job, inside ``foreachBatch`` and over a streaming DataFrame.
"""

from flightlake.session import checkpoint_root, get_session

__all__ = ["get_session", "checkpoint_root"]

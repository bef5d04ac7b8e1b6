"""sparkwright: reusable PySpark DataFrame operators and analytics jobs.

Every operator is a function ``DataFrame -> DataFrame`` (compose with
``df.transform``). Work stays inside Catalyst: built-in column functions,
aggregates, joins and windows; pandas only inside Arrow-batched tasks where a
built-in cannot express the step.
"""

from sparkwright.session import build_session, ensure_checkpoint_dir

__all__ = ["build_session", "ensure_checkpoint_dir"]

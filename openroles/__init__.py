"""openroles: job-posting and sponsorship-filing analytics as Spark DataFrame jobs."""

import sys

from pyspark import cloudpickle

from openroles.session import build_session, prepare

# The few Python functions that run in tasks travel with the job, so executors
# need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

__all__ = ["build_session", "prepare"]

"""weblens: web-server logs as Spark jobs."""

from weblens.operators import *  # noqa: F403
from weblens.plans import *  # noqa: F403
from weblens.session import spark_session
from weblens.sinks import *  # noqa: F403
from weblens.sources import *  # noqa: F403

__all__ = ["spark_session"]

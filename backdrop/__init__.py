"""Frame tables on Spark.

Frames (images, video frames, capture records) are rows of one DataFrame
schema; the pixel work runs in Arrow batches inside ``mapInArrow`` and every
relational step (filters, numbering, summaries, joins) stays in the
DataFrame API so Catalyst plans it.
"""

import sys as _sys


def _ship_by_value() -> None:
    """Pickle this package's functions and classes by value.

    Python workers then need no installed copy of ``backdrop`` (on a cluster,
    or when the driver imports it from a path the workers do not see).
    """
    try:
        from pyspark import cloudpickle
        cloudpickle.register_pickle_by_value(_sys.modules[__name__])
    except (ImportError, AttributeError, ValueError):  # pragma: no cover - older cloudpickle
        pass


_ship_by_value()

from backdrop.config import configure, make_session, checkpoint_dir  # noqa: E402

__all__ = ["configure", "make_session", "checkpoint_dir"]

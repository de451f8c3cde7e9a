"""tradeflow: trade-regime analytics as plain PySpark DataFrame operators.

Every operator is a ``DataFrame -> DataFrame`` function (usable with
``df.transform``) built from Spark's built-in expressions, so Catalyst plans,
prunes and code-generates the whole chain.  Only ``sources``, ``sinks``,
``plans.job`` and ``streaming`` touch storage.

    from tradeflow import make_session, TradeModel, run_job, Warehouse
"""

__version__ = "0.1.0"

from tradeflow.model import TradeModel  # noqa: E402
from tradeflow.plans.job import Layout, run_job, upsert_bronze  # noqa: E402
from tradeflow.session import make_session  # noqa: E402
from tradeflow.warehouse import Warehouse  # noqa: E402

__all__ = ["Layout", "TradeModel", "Warehouse", "make_session", "run_job", "upsert_bronze"]

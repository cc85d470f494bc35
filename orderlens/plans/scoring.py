"""The order queue end to end: recent orders, scored, riskiest first."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame

from orderlens.config import DEFAULTS, Settings
from orderlens.operators import model as models
from orderlens.operators import queue
from orderlens.session import staged


def order_queue(model: PipelineModel, tables: Mapping[str, DataFrame], settings: Settings = DEFAULTS) -> DataFrame:
    """The ``queue_length`` riskiest of the ``recent_orders`` latest orders."""
    latest = queue.recent_orders(tables["orders"], tables["order_items"], settings)
    # A handful of rows used on two sides of a join: written once.
    waiting = staged(queue.payloads(latest, tables, settings, chosen=True))
    scores = models.score_batch(model, waiting, settings)
    return queue.priority_queue(queue.scores_to_orders(scores, waiting), settings)

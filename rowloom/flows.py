"""Result type of operators with more than one output."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame


class Flows(NamedTuple):
    """Rows that went through, and the rows that did not."""

    accepted: DataFrame
    rejected: DataFrame

"""rowloom: ETL operators as PySpark DataFrame and Structured Streaming jobs."""

from rowloom.flows import Flows
from rowloom.session import materialize, scratch_path, session

__all__ = ["Flows", "materialize", "scratch_path", "session"]

"""fjord — a Spark-native transaction lakehouse.

Landing → bronze → silver → gold, quality profiles and alerts, model metrics
and top-k retrieval, all expressed as lazy DataFrame-to-DataFrame operators.
"""

from fjord.config import Paths, checkpoint_root
from fjord.session import get_spark

__all__ = ["Paths", "checkpoint_root", "get_spark"]

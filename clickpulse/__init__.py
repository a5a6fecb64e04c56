"""clickpulse: website click analytics on Spark.

Speed layer (streaming window counts), batch layer (all-time report),
read-back views, page statistics, page visits and a spend report, all
expressed with DataFrame / SQL / Structured Streaming built-ins.
"""

from clickpulse.config import LayerConfig

__all__ = ["LayerConfig"]

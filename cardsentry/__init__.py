"""cardsentry: Spark-native payment-risk analytics.

Every operator is a function DataFrame -> DataFrame built from the public
DataFrame / SQL / Structured Streaming / MLlib API, so Catalyst plans the work
and the same code runs on ``local[8]`` and on a large cluster.
"""

__version__ = "0.1.0"

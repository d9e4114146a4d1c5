"""shopflow: behaviour-log features, splits, boosted-tree training, scoring and
evaluation expressed as Spark DataFrame / MLlib jobs."""

__version__ = "0.1.0"

"""lakemart: Spark-native operators for turning drifting, text-heavy survey
editions into analytics marts (bronze -> silver -> gold)."""

__version__ = "0.1.0"

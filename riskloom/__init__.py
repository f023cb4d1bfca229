"""riskloom — a Spark-native engine for binary risk scoring and data quality.

Every step (typed ingest, data contracts, features and encodings, ordered splits,
metrics over scores, drift, calibration, model fits and scoring) is a DataFrame
transformation or a Spark ML estimator, so tables stay distributed from scan to
report. Only bounded things (model coefficients, bucket boundaries, small reports)
ever reach the driver.
"""

from riskloom.session import build_session, checkpoint_root

__all__ = ["build_session", "checkpoint_root"]

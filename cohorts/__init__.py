"""Customer segmentation on Spark: check, prepare, profile, cluster, judge, score."""

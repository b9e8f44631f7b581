"""Monthly credit-risk data on Spark: ingest, cleansing, features, splits,
training, scoring and drift monitoring as DataFrame functions."""

"""geoloom: a Spark-first engine for spatial warehouse work and text corpora."""

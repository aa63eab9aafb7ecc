"""martloom: a layered retail warehouse (detail, summary, metrics, serving) on Spark."""

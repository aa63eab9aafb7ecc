"""Layer by layer: detail, summary, metrics, serving, page views, checks, goods."""

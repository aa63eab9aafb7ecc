"""Feeds, sample data, the table catalog and the warehouse folder."""

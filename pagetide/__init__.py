"""Page-creation analytics on Spark: keyed views, windowed reports and lookups."""

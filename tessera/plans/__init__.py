"""The four analyses as functions (spark, sf_dir) -> DataFrame, one per registered query."""

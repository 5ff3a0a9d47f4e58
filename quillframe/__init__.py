"""quillframe: table, time-series, statistics, model and text operators for Spark."""

"""Jobs that read and write lake layers, the daily pipeline, and the query catalog."""

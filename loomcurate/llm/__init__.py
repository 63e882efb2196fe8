"""Training-data operators: packing, chat windows, mixing, quality rules, scans, joins and search."""

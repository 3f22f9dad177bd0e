"""Row and relational operators of the trip pipeline (gate, enrich, clean, features,
rollups, views, anomaly bands, benchmark scores)."""

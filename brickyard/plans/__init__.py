"""Jobs (ingest, summarise) and plan-inspection helpers."""

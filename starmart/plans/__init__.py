"""Warehouse jobs (detail layer, marts, refresh) and the query catalogue."""

"""Physical-plan helpers (skew-safe numbering, checked broadcasts) and the query catalogue."""

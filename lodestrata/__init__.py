"""Insert-only, auditable warehousing as ordinary DataFrame operators."""

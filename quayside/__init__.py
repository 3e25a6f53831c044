"""Vessel port-call analytics on Spark: positions -> anchorages -> port events -> visits -> voyages."""

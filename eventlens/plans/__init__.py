"""Registered plans: table adapters, the query catalog and its SQL oracles."""

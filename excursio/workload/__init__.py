"""Queries over the given tables, each with the SQL that must give the same rows."""

from importlib import import_module

from excursio.workload.registry import ORACLES, QUERIES

for _family in ("scalars", "captured", "listings", "earlier_rules", "records", "responses", "files", "runs"):
    import_module(f"excursio.workload.{_family}")

# name -> (query, oracle SQL or None)
ALL = {name: (fn, ORACLES.get(name)) for name, fn in QUERIES.items()}

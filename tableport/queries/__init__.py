"""Every registered query with its equivalent SQL."""

from . import bundles, catalog, graphs, quality, scans, telemetry, values

_MODULES = (scans, catalog, values, bundles, quality, telemetry, graphs)

QUERIES = {name: fn for module in _MODULES for name, fn in module.QUERIES.items()}
ORACLES = {name: sql for module in _MODULES for name, sql in module.ORACLES.items()}

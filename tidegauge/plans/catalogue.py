"""All registered queries and their SQL twins."""

from __future__ import annotations

from tidegauge.plans import decoding, filtering, grid, modelling, streams, windows

_ALL = {}
for _module in (grid, filtering, decoding, windows, modelling, streams):
    _ALL.update(_module.QUERIES)

QUERIES = {name: run for name, (run, _) in _ALL.items()}
ORACLES = {name: sql for name, (_, sql) in _ALL.items() if sql is not None}

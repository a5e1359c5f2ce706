"""All registered queries and checks."""

from __future__ import annotations

from workload import audits, cleaning, evaluation, manifests, mart, race

MODULES = (mart, cleaning, audits, manifests, evaluation, race)

QUERIES: dict = {}
ORACLES: dict = {}
#: Queries whose results SQL cannot say.
UNCHECKED = {**audits.UNCHECKED, **evaluation.UNCHECKED}
for module in MODULES:
    QUERIES.update(module.QUERIES)
    ORACLES.update(module.ORACLES)

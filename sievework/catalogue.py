"""All queries of the engine and the SQL they are held against."""

from sievework.plans import documents, planning, reports, revisions, rules, structures, texts

_PLANS = (reports, texts, structures, documents, planning, revisions, rules)
QUERIES = {k: f for p in _PLANS for k, f in p.QUERIES.items()}
ORACLES = {k: s for p in _PLANS for k, s in p.ORACLES.items()}

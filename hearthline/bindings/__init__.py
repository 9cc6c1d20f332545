"""Every operator run on the given tables, next to the SQL it must equal."""

from hearthline.bindings import history, ledger, loading, records, searching, writing

QUERIES = {}
ORACLES = {}
for _module in (loading, records, writing, history, ledger, searching):
    for _name, (_query, _sql) in _module.BINDINGS.items():
        QUERIES[_name] = _query
        if _sql is not None:
            ORACLES[_name] = _sql

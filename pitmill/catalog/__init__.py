"""Registered queries over the given tables, each with the SQL that checks it."""

from pitmill.catalog import audits, domain, flows, panel

QUERIES = {**panel.QUERIES, **domain.QUERIES, **audits.QUERIES, **flows.QUERIES}
ORACLE = {**panel.ORACLE, **domain.ORACLE, **audits.ORACLE, **flows.ORACLE}

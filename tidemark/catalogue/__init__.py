"""Registered queries over the star tables, each next to its SQL counterpart."""

from . import checks, contract_checks, guards, history, incremental, marts, shaping

SECTIONS = (shaping, marts, incremental, history, checks, guards, contract_checks)


def queries():
    return {name: run for section in SECTIONS for name, run in section.QUERIES.items()}


def oracle_sql():
    return {name: sql for section in SECTIONS for name, sql in section.ORACLES.items()}

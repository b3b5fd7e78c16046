"""Registered queries over event files and their SQL twins."""

from __future__ import annotations

from . import relational, scans

SPECS = {**scans.SPECS, **relational.SPECS}


def queries():
    return {name: run for name, (run, _) in SPECS.items()}


def oracle_sql():
    return {name: sql for name, (_, sql) in SPECS.items() if sql}

"""All registered queries."""

from registry import flows, rules, tables

ALL = [*rules.QUERIES, *tables.QUERIES, *flows.QUERIES]

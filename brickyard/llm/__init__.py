"""Operators for preparing training text at scale.

Each module holds one operator; ``queries`` registers one query per operator
(``opN_<name>``) and their SQL. Nothing outside this subpackage imports it.

Shared conventions: a NULL text counts as empty; extra columns never reach an
operator's working tables, so names that clash with them are harmless; results
that need more than one pass are written under the session's checkpoint folder
(``tables.written``), which cuts lineage and survives lost executors.
"""

"""Registered queries, by name, with their SQL; and whole jobs."""


def queries() -> dict:
    from . import pixels, relational, scalars

    return scalars.QUERIES | relational.QUERIES | pixels.QUERIES


def oracle_sql() -> dict[str, str]:
    from . import pixels, relational, scalars

    return scalars.ORACLE | relational.ORACLE | pixels.ORACLE

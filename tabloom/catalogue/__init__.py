"""The registered queries and the SQL they are checked against."""

from tabloom.catalogue import models, monitoring, profiles, serving, transforms

PARTS = (profiles, transforms, models, serving, monitoring)


def all_queries() -> dict:
    return {k: v for part in PARTS for k, v in part.QUERIES.items()}


def all_oracles() -> dict:
    return {k: v for part in PARTS for k, v in part.ORACLE.items()}

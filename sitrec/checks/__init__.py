"""Named queries over the test tables, each with its SQL twin where there is one."""

from sitrec.checks import evidence, feature, flows, learned, machine, normal, relational  # noqa: F401  (they register queries)
from sitrec.checks.base import ENTRIES

__all__ = ["ENTRIES"]

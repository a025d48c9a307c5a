"""Named queries over the given tables and the SQL each is checked against."""

from footfall.plans.catalogue import CATALOGUE as _ON_THE_LOG
from footfall.plans.oracle import ORACLE as _SQL
from footfall.plans.stored import STORED, STORED_SQL

CATALOGUE = {**_ON_THE_LOG, **STORED}
ORACLE = {**_SQL, **STORED_SQL}

__all__ = ["CATALOGUE", "ORACLE"]

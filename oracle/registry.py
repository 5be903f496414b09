"""All oracle SQL by query key."""

from oracle.analytics import ANALYTICS
from oracle.bronze import BRONZE
from oracle.reports import RELATIONAL

ORACLE: dict[str, str] = {**RELATIONAL, **ANALYTICS, **BRONZE}

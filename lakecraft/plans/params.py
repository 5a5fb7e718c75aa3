"""Query parameters shared by the Spark plans and their oracle SQL.

``CURRENT_DATE`` in the reference's SQL becomes the explicit ``AS_OF`` date
(the last order date of the test data), thresholds are scaled to its amounts.
"""

import datetime as dt

AS_OF = dt.date(2001, 8, 1)
AS_OF_SQL = "DATE '2001-08-01'"
CATEGORY = "ECONOMY"            # category filter of challenge 2 / dashboards
BIG_ORDER = 400000              # challenge 3 threshold
BIG_SPENDER = 3000000           # challenge 12 HAVING threshold
REVENUE_MIN = 2500000           # challenge 14 threshold

"""Micro-fixture M1 (hand-computed answers), as_of = 2024-06-15."""
from datetime import datetime as dt

from usagelens.sources import schemas as S

AS_OF = "2024-06-15 00:00:00"

USERS = [(1, dt(2024, 1, 1), "India"), (1, dt(2024, 1, 1), None), (2, dt(2024, 1, 3), None),
         (3, dt(2024, 1, 10), "Canada"), (4, dt(2024, 1, 10), "India")]
SESSIONS = [(10, 1, dt(2024, 1, 1, 23), 10.0), (11, 1, dt(2024, 1, 3, 1), None),
            (12, 1, dt(2024, 1, 9, 12), 30.0), (12, 1, dt(2024, 1, 9, 12), 30.0),
            (13, 2, dt(2024, 1, 10, 8), 20.0), (14, None, dt(2024, 1, 10, 9), 99.0),
            (15, 3, None, 40.0)]
EVENTS = [(1, 1, 1, "click", "reports", dt(2024, 1, 1, 23)), (2, 1, 1, "click", "reports", dt(2024, 1, 1, 23)),
          (3, 2, 2, "view", None, dt(2024, 1, 10, 8)), (3, 2, 2, "view", None, dt(2024, 1, 10, 8)),
          (4, None, 4, "view", "billing", dt(2024, 1, 10, 9))]
PAYMENTS = [(1, "growth", 129.0, dt(2024, 1, 16)), (1, "GROWTH", 129.0, dt(2024, 2, 15)),
            (1, "starter", 49.0, dt(2024, 3, 16)), (1, "starter", 49.0, dt(2024, 4, 15)),
            (2, "free", 0.0, dt(2024, 1, 18)), (3, "enterprise", 499.0, None)]


def raw(spark, empty=False):
    def mk(rows, schema):
        return spark.createDataFrame([] if empty else rows, schema)
    return {"users": mk(USERS, S.USERS), "sessions": mk(SESSIONS, S.SESSIONS),
            "events": mk(EVENTS, S.EVENTS), "payments": mk(PAYMENTS, S.PAYMENTS)}


def tables(spark, empty=False):
    from usagelens.plans.pipeline import process
    return process(raw(spark, empty), AS_OF)

"""The golden replica and increment: one entity for each rule of the merge."""

from datetime import date

OPEN = date(5999, 12, 31)
SCHEMA = "id bigint, payload string, eff_from_dt date, eff_to_dt date"


def _row(key, payload, start, end):
    return (key, payload, date.fromisoformat(start), date.fromisoformat(end) if end else None)


REPLICA = [
    _row(1, "r1", "2024-01-10", "5999-12-31"),
    _row(2, "r2", "2024-01-11", "5999-12-31"),
    _row(3, "r3", "2024-02-05", "5999-12-31"),
    _row(4, "r4", "2024-02-06", "5999-12-31"),
    _row(5, "r5", "2024-03-20", "5999-12-31"),
    _row(7, "r7", "2024-01-15", "5999-12-31"),
    _row(8, "r8", "2024-02-07", "5999-12-31"),
    _row(9, "r9", "2024-01-20", "5999-12-31"),
    _row(11, "r11", "2024-01-25", "5999-12-31"),
    _row(None, "rN", "2024-01-09", "5999-12-31"),
    _row(12, "r12", "2024-04-02", "5999-12-31"),
]

INCREMENT = [
    _row(1, "r1", "2024-01-10", "2024-05-31"),
    _row(1, "i1", "2024-06-01", "5999-12-31"),
    _row(3, "r3", "2024-02-05", "2024-05-31"),
    _row(4, "i4", "2024-06-02", "5999-12-31"),
    _row(5, "i5", "2024-02-01", "5999-12-31"),
    _row(6, "i6", "2024-06-03", "5999-12-31"),
    _row(7, "r7", "2024-01-15", "2024-05-10"),
    _row(7, "i7a", "2024-05-11", "2024-06-04"),
    _row(7, "i7b", "2024-06-05", "5999-12-31"),
    _row(8, "r8", "2024-02-07", "5999-12-31"),
    _row(9, "i9", "2024-05-01", "2024-05-20"),
    _row(10, "i10a", "2024-05-02", "2024-05-30"),
    _row(10, "i10b", "2024-05-31", "5999-12-31"),
    _row(11, "i11", "2024-06-06", "5999-12-15"),
    _row(None, "iN", "2024-01-09", "2024-05-31"),
    _row(13, "i13", "2024-06-07", None),
    _row(12, "r12", "2024-04-02", "2024-05-31"),
    _row(12, "i12", "2024-06-08", "5999-12-31"),
]

# replica payloads still open afterwards
KEPT_CLOSED_KEY = {"r2", "r4", "r5", "r8", "r9", "r11", "rN"}
KEPT_LATEST = {"r2", "r3", "r5", "rN"}
# increment payloads the latest strategy drops, beside one of the two r8 rows
DROPPED_LATEST = {"i5", "i13"}


def expected_closed_key():
    return INCREMENT + [r for r in REPLICA if r[1] in KEPT_CLOSED_KEY]


def expected_latest():
    kept = [r for r in REPLICA if r[1] in KEPT_LATEST]
    return [r for r in INCREMENT if r[1] not in DROPPED_LATEST] + kept

"""Scalar building blocks, all native Spark expressions.

Instants are ``timestamp_ntz`` holding UTC wall-clock time, so no result depends on the session
time zone. Text of an instant comes from a cast, never from ``date_format`` (which would go
through the session zone).
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from ledgerlake.contracts import MAX_TS, STATE_DIGITS, TOLERANCE_DAYS

NTZ = "timestamp_ntz"


def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def end_of_time() -> Column:
    return F.lit(MAX_TS).cast(NTZ)


def to_utc(ts: str | Column) -> Column:
    """Zoned instant -> UTC wall clock, exact across daylight-saving changes."""
    seconds = F.unix_micros(col(ts)).cast("decimal(26,6)") / F.lit(1_000_000).cast("decimal(26,6)")
    epoch = F.lit("1970-01-01 00:00:00").cast(NTZ)
    return epoch + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), seconds.cast("decimal(18,6)"))


def month_of(ts: str | Column) -> Column:
    return F.substring(col(ts).cast("string"), 1, 7)


def month_start(month: str | Column) -> Column:
    return F.concat(col(month), F.lit("-01")).cast("date")


def month_close(month: str | Column, days: int = TOLERANCE_DAYS) -> Column:
    """First instant after the month plus the tolerance: later records are late."""
    return F.date_add(F.add_months(month_start(month), 1), days).cast(NTZ)


def year_of(ts: str | Column) -> Column:
    return F.year(col(ts).cast("date"))


def seconds_between(start: str | Column, end: str | Column) -> Column:
    """Exact seconds as decimal(20,6)."""
    return (col(end) - col(start)).cast("interval second").cast("decimal(20,6)")


def differs(a: str | Column, b: str | Column) -> Column:
    """NULL-safe inequality."""
    return ~col(a).eqNullSafe(col(b))


def all_of(conditions: Iterable[Column]) -> Column:
    return reduce(lambda a, b: a & b, conditions)


def any_of(conditions: Iterable[Column]) -> Column:
    return reduce(lambda a, b: a | b, conditions)


def pct(part: Column, whole: Column, digits: int) -> Column:
    """100 * part / whole as double, NULL when the whole is zero."""
    return F.round(F.lit(100.0) * part / F.nullif(whole, F.lit(0)), digits)


def hash_number(text: Column) -> Column:
    """64 bits of the md5 of a text as an exact, summable number."""
    return F.conv(F.substring(F.md5(text), 17, 16), 16, 10).cast("decimal(28,0)")


def surrogate_key(text: Column) -> Column:
    """Deterministic positive long from a text."""
    return F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("bigint")


def instant_text(ts: str | Column) -> Column:
    """Instant with microseconds always written out."""
    text = col(ts).cast("string")
    fraction = F.rpad(F.substring(text, 21, 6), 6, "0")
    return F.concat(F.substring(text, 1, 10), F.lit("T"), F.substring(text, 12, 8), F.lit("."), fraction)


def profile_key(entity: str | Column, start: str | Column) -> Column:
    return surrogate_key(F.concat_ws("|", col(entity).cast("string"), instant_text(start)))


def row_text(columns: Sequence[str], null_text: str = "nulo") -> Column:
    """Unambiguous text of a row: ``concat_ws`` skips NULL, so NULL is written out."""
    return F.concat_ws("|", *[F.coalesce(F.col(c).cast("string"), F.lit(null_text)) for c in columns])


def entries_text(mapping: str | Column) -> Column:
    """Map -> ``k=v`` entries in key order: comparable, hashable and stable."""
    entries = F.array_sort(F.map_entries(col(mapping)))
    return F.array_join(
        F.transform(entries, lambda e: F.concat(e["key"], F.lit("="), e["value"].cast("string"))), ","
    )


def stable_json(mapping: str | Column) -> Column:
    """JSON object with its keys in order: equal maps give equal text."""
    return F.to_json(F.map_from_entries(F.array_sort(F.map_entries(col(mapping)))))


def truncated(text: str | Column, limit: int) -> Column:
    return F.substring(col(text), 1, limit)


#: Fixed value: form of an operational id.
OPERATOR = "operador-[0-9]{2,6}"


def valid_operator(operator: str | Column) -> Column:
    """Operational ids name no person: the word operador, a dash and two to six digits."""
    return col(operator).rlike(f"^{OPERATOR}$")


def encode_items(mapping: str | Column, catalog: Sequence[str]) -> Column:
    """One digit per catalog item, in catalog order."""
    digits = F.create_map(*[F.lit(x) for pair in STATE_DIGITS.items() for x in pair])
    state = [F.try_element_at(col(mapping), F.lit(code)) for code in catalog]
    return F.concat(*[F.coalesce(F.try_element_at(digits, s), F.lit("0")) for s in state])


def finite(x: str | Column) -> Column:
    """NULL for NaN and infinities."""
    value = col(x).cast("double")
    return F.when(~F.isnan(value) & (F.abs(value) < F.lit(float("inf"))), value)


def band_label(value: str | Column, edges: Sequence[int]) -> Column:
    """Half-open bands; the last one is open: 1, 2 a 4, ..., 100 ou mais."""
    labels = [
        str(lo) if hi - lo == 1 else f"{lo} a {hi - 1}" for lo, hi in zip(edges, edges[1:])
    ] + [f"{edges[-1]} ou mais"]
    out = F.lit(labels[-1])
    for edge, label in reversed(list(zip(edges[1:], labels))):
        out = F.when(col(value) < edge, F.lit(label)).otherwise(out)
    return out


def band_index(value: str | Column, edges: Sequence[int]) -> Column:
    out = F.lit(len(edges) - 1)
    for i in range(len(edges) - 2, -1, -1):
        out = F.when(col(value) < edges[i + 1], F.lit(i)).otherwise(out)
    return out

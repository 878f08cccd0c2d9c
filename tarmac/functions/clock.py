"""Clock-time Column builders (no UDFs: everything stays in whole-stage codegen).

Rules implemented here:

R1 local date + ``HHmm`` text + IANA zone -> UTC epoch milliseconds
   * any input null -> 0 (the epoch), unless ``null_sentinels=True`` (then null);
   * the text is left-padded to 4 with ``0`` (longer text is cut to 4) and read
     leniently: hours/minutes past their range roll over (``2400`` is next-day 00:00,
     ``1260`` is 13:00);
   * in the repeated hour when clocks go back, the *later* instant is taken; in the
     skipped hour when clocks go forward, the time is shifted forward by the gap;
   * text that is not a number fails the job (``on_error="fail"``) or gives null
     (``on_error="null"``).

R2 arrival repair (first match wins)
   (a) origin zone Pacific/Guam and destination zone Pacific/Honolulu: keep the
       arrival if departure clock > 1600 and arrival clock < 600, else one day earlier;
   (b) arrival before departure: one day later;
   (c) otherwise unchanged.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

DAY_MS = 86_400_000
HOUR_MS = 3_600_000
MINUTE_MS = 60_000

# Fixed values for R2 (a): the date-line pair and its clock thresholds.
DATELINE_ORIGIN_ZONE = "Pacific/Guam"
DATELINE_DEST_ZONE = "Pacific/Honolulu"
DATELINE_LATE_DEPARTURE = 1600
DATELINE_EARLY_ARRIVAL = 600


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def hhmm(time_col) -> Column:
    """F-03: left-pad a clock text to 4 characters with ``0``."""
    return F.lpad(_c(time_col), 4, "0")


def date_time_text(date_col, time_col) -> Column:
    """F-12: date text followed by the padded clock text."""
    return F.concat(_c(date_col).cast("string"), hhmm(time_col))


def _to_int(text: Column, on_error: str, what: str) -> Column:
    parsed = text.try_cast("int")
    if on_error == "null":
        return parsed
    if on_error != "fail":
        raise ValueError("on_error must be 'fail' or 'null'")
    return F.when(text.isNotNull() & parsed.isNull(),
                  F.raise_error(F.concat(F.lit(f"unparseable {what}: "), text))).otherwise(parsed)


def local_wall_millis(date_col, time_col, on_error: str = "fail") -> Column:
    """Wall-clock of (date, HHmm) as milliseconds since 1970-01-01T00:00 of that clock.

    The padded 4-character text is read as one number: hours = n div 100 and
    minutes = n mod 100, each allowed past its range (lenient reading).
    """
    clock = _to_int(hhmm(time_col), on_error, "clock time").cast("long")
    hours = F.floor(clock / 100)
    return (F.unix_date(_c(date_col)).cast("long") * DAY_MS
            + hours * HOUR_MS + (clock - hours * 100) * MINUTE_MS)


# An offset change within this window after the earlier reading is what a repeated
# local hour looks like (clock shifts are at most a few hours, months apart).
SHIFT_PROBE_MS = 3 * HOUR_MS


def _offset_after(earlier: Column, zone: Column) -> Column:
    """UTC offset (ms) in force ``SHIFT_PROBE_MS`` after the instant ``earlier``."""
    probe = earlier + SHIFT_PROBE_MS
    return F.unix_millis(F.from_utc_timestamp(F.timestamp_millis(probe), zone)) - probe


def _pick_later(wall: Column, earlier: Column, later: Column, zone: Column) -> Column:
    """True when ``later`` is a second, later reading of the same wall clock (the
    repeated hour when clocks go back, of whatever length)."""
    return (later > earlier) & (
        F.unix_millis(F.from_utc_timestamp(F.timestamp_millis(later), zone)) == wall)


def utc_millis(date_col, time_col, zone_col, *, null_sentinels: bool = False,
               on_error: str = "fail") -> Column:
    """F-01 / R1: local date + clock text + zone id -> UTC epoch milliseconds (long).

    ``zone_col`` may hold region ids (``America/New_York``) or offsets (``-05:00``).
    Independent of the session time zone: the wall clock is encoded as a UTC
    timestamp and shifted with ``to_utc_timestamp``/``from_utc_timestamp``.
    ``to_utc_timestamp`` already shifts skipped clocks forward; for repeated clocks it
    gives the earlier reading, so the later one is derived from the offset in force
    just after and taken when it reads back to the same wall clock.
    Single-column form; :func:`with_utc_millis` is the staged form used for throughput.
    """
    date_c, time_c, zone_c = _c(date_col), _c(time_col), _c(zone_col)
    wall = local_wall_millis(date_c, time_c, on_error)
    earlier = F.unix_millis(F.to_utc_timestamp(F.timestamp_millis(wall), zone_c))
    later = wall - _offset_after(earlier, zone_c)
    instant = F.when(_pick_later(wall, earlier, later, zone_c), later).otherwise(earlier)
    missing = date_c.isNull() | time_c.isNull() | zone_c.isNull()
    sentinel = F.lit(None).cast("long") if null_sentinels else F.lit(0).cast("long")
    return F.when(missing, sentinel).otherwise(instant)


def with_utc_millis(df: DataFrame, specs: list[tuple[str, str, str, str]], *,
                    null_sentinels: bool = False, on_error: str = "fail") -> DataFrame:
    """R1 for several (output, date, time, zone) column sets, as staged projections.

    Same result as :func:`utc_millis`, planned for throughput: the wall clock, the
    earlier reading, the offset just after it, and the final choice are separate
    projections, so each zone conversion runs once per row (inside one conditional
    expression Spark cannot share sub-results between branches). The read-back check
    runs only for rows whose offset changes within the probe window. Catalyst keeps
    the stages apart because merging them would repeat the non-trivial expressions.
    """
    wall = {o: f"__wall_{o}" for o, *_ in specs}
    early = {o: f"__early_{o}" for o, *_ in specs}
    late = {o: f"__late_{o}" for o, *_ in specs}
    s1 = df.select("*", *[local_wall_millis(d, t, on_error).alias(wall[o]) for o, d, t, _ in specs])
    s2 = s1.select("*", *[F.unix_millis(F.to_utc_timestamp(F.timestamp_millis(wall[o]), F.col(z)))
                          .alias(early[o]) for o, _, _, z in specs])
    s3 = s2.select("*", *[(F.col(wall[o]) - _offset_after(F.col(early[o]), F.col(z))).alias(late[o])
                          for o, _, _, z in specs])
    sentinel = F.lit(None).cast("long") if null_sentinels else F.lit(0).cast("long")
    outs = []
    for o, d, t, z in specs:
        e, w, lt = F.col(early[o]), F.col(wall[o]), F.col(late[o])
        missing = F.col(d).isNull() | F.col(t).isNull() | F.col(z).isNull()
        outs.append(F.when(missing, sentinel).when(_pick_later(w, e, lt, F.col(z)), lt)
                    .otherwise(e).alias(o))
    return s3.select(*df.columns, *outs)


def clock_number(time_col) -> Column:
    """The clock text read as an integer (``"855"`` -> 855); null when not a number."""
    return _c(time_col).try_cast("int")


def repair_arrival(dep_ms, arr_ms, origin_zone, dest_zone, dep_clock, arr_clock) -> Column:
    """F-02 / R2: move the arrival instant to the right calendar day.

    The zone test is null-safe; a missing clock makes the (a) comparison false.
    """
    dep, arr = _c(dep_ms), _c(arr_ms)
    dateline = (_c(origin_zone).eqNullSafe(F.lit(DATELINE_ORIGIN_ZONE))
                & _c(dest_zone).eqNullSafe(F.lit(DATELINE_DEST_ZONE)))
    keep = F.coalesce((clock_number(dep_clock) > DATELINE_LATE_DEPARTURE)
                      & (clock_number(arr_clock) < DATELINE_EARLY_ARRIVAL), F.lit(False))
    # Day shift in {-1, 0, +1}; the instants appear outside the branches, so Spark
    # computes them once per row.
    before = (arr < dep).cast("long")
    shift = F.when(dateline, F.when(keep, F.lit(0)).otherwise(F.lit(-1))).otherwise(before)
    return arr + shift * DAY_MS


def epoch_seconds(ts_col) -> Column:
    """F-05: timestamp -> epoch seconds."""
    return F.unix_timestamp(_c(ts_col))


def delay_minutes(arr_ts, dep_ts, elapsed) -> Column:
    """F-06: (arrival - departure) in minutes minus the recorded elapsed minutes (double)."""
    return (epoch_seconds(arr_ts) - epoch_seconds(dep_ts)) / 60 - _c(elapsed)


def elapsed_minutes(arr_ms, dep_ms) -> Column:
    """F-07: minutes between two epoch-millisecond instants (double)."""
    return (_c(arr_ms) - _c(dep_ms)) / MINUTE_MS


def inverse_delay_minutes(elapsed, arr_ms, dep_ms) -> Column:
    """F-08: the exploration's opposite-sign delay, elapsed - time taken."""
    return _c(elapsed) - elapsed_minutes(arr_ms, dep_ms)


def ground_minutes(elapsed, air_time) -> Column:
    """F-09: minutes on the ground = elapsed - air time."""
    return _c(elapsed) - _c(air_time)


def air_time_bucket(air_time, width: int = 10) -> Column:
    """F-10: air time rounded *up* to a multiple of ``width`` (null stays null)."""
    return (F.ceil(_c(air_time) / F.lit(float(width))) * width).cast("int")


def zone_offset_text(offset_hours, signed: bool = False) -> Column:
    """F-11: whole-hour offset -> 4-digit text with a sign, e.g. -9 -> ``-0900``.

    Parity form (``signed=False``): drop the first character, left-pad to 2, right-pad
    to 4 (no truncation of longer text), always prefix ``-`` — so +10 gives ``-0000``.
    ``signed=True`` derives the sign and digits from the value instead.
    """
    raw = _c(offset_hours).cast("string")
    if signed:
        value = _c(offset_hours).cast("int")
        digits = F.lpad(F.abs(value).cast("string"), 2, "0")
        return F.when(value.isNull(), F.lit(None).cast("string")).otherwise(
            F.concat(F.when(value < 0, F.lit("-")).otherwise(F.lit("+")), digits, F.lit("00")))
    tail = F.substring(raw, 2, 1 << 20)
    left = F.when(F.length(tail) >= 2, tail).otherwise(F.lpad(tail, 2, "0"))
    right = F.when(F.length(left) >= 4, left).otherwise(F.rpad(left, 4, "0"))
    return F.when(raw.isNull(), F.lit(None).cast("string")).otherwise(F.concat(F.lit("-"), right))


def offset_zone_id(offset_text) -> Column:
    """F-13: ``-0500`` style text -> ``-05:00`` zone id usable by :func:`utc_millis`."""
    t = _c(offset_text)
    return F.concat(t.substr(1, 3), F.lit(":"), t.substr(4, 2))

"""R1 against a brute-force reference built on Python's tz database.

For a local wall clock, the two readings fold=0 / fold=1 differ only in a skipped or
repeated hour; the rule wanted (shift forward in a gap, later instant in an overlap)
is the later of the two in both cases.
"""

from datetime import date, datetime, timedelta, timezone
from zoneinfo import ZoneInfo

from hypothesis import given, settings
from hypothesis import strategies as st

from tarmac.functions.clock import utc_millis, with_utc_millis

ZONES = ["America/New_York", "America/Chicago", "America/Denver", "America/Phoenix",
         "America/Los_Angeles", "America/Anchorage", "Pacific/Honolulu", "Pacific/Guam",
         "America/Puerto_Rico", "Europe/London", "Australia/Lord_Howe", "Asia/Kolkata", "UTC"]

rows = st.lists(st.tuples(
    st.dates(min_value=date(1990, 1, 1), max_value=date(2035, 12, 31)),
    st.integers(min_value=0, max_value=2459),
    st.sampled_from(ZONES)), min_size=1, max_size=300)


def expected(d: date, clock: int, zone: str) -> int:
    wall = datetime(d.year, d.month, d.day) + timedelta(hours=clock // 100, minutes=clock % 100)
    z = ZoneInfo(zone)
    candidates = [wall.replace(tzinfo=z, fold=f).astimezone(timezone.utc) for f in (0, 1)]
    return int(max(candidates).timestamp() * 1000)


@settings(max_examples=6, deadline=None)
@given(rows)
def test_r1_matches_tz_database(spark, batch):
    data = [(d, str(c), z) for d, c, z in batch]
    df = spark.createDataFrame(data, "d date, t string, z string")
    single = [r.ms for r in df.select(utc_millis("d", "t", "z").alias("ms")).collect()]
    staged = [r.ms for r in with_utc_millis(df, [("ms", "d", "t", "z")]).select("ms").collect()]
    want = [expected(d, c, z) for d, c, z in batch]
    assert single == want
    assert staged == want


def test_r1_transition_days_exhaustive(spark):
    # Every minute of both 2012 clock-change days in New York and Lord Howe (30-minute shift).
    data = [(day, str(h * 100 + m), z)
            for z in ("America/New_York", "Australia/Lord_Howe")
            for day in (date(2012, 3, 11), date(2012, 11, 4), date(2012, 4, 1), date(2012, 9, 30))
            for h in range(24) for m in range(60)]
    df = spark.createDataFrame(data, "d date, t string, z string")
    got = [r.ms for r in with_utc_millis(df, [("ms", "d", "t", "z")]).select("ms").collect()]
    want = [expected(d, int(t), z) for d, t, z in data]
    bad = [(data[i], got[i], want[i]) for i in range(len(data)) if got[i] != want[i]]
    assert not bad, bad[:5]

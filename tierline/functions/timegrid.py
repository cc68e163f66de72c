"""Time buckets, slices, file-name times and archive block keys."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from tierline.schema import GRID_START_EPOCH

# Date patterns of event text, file names and archive blocks.
EVENT_TIME_FORMAT = "yyyy-MM-dd HH:mm:ss"
FILE_TIME_FORMAT = "yyyy-MM-dd-HH-mm-ss"
BLOCK_FORMATS = {"hour": "yyyy-MM-dd-HH", "day": "yyyy-MM-dd"}
FILE_NAME_PATTERN = r"(?:^|/)(\d{4}(?:-\d{2}){5})(?:-(\d+))?"
BLOCK_SECONDS = {"hour": 3600, "day": 86400}


def parse_event_time(text: Column) -> Column:
    """Event text to TIMESTAMP; unreadable text becomes NULL."""
    return F.try_to_timestamp(F.rtrim(text, F.lit(" UTC")), F.lit(EVENT_TIME_FORMAT))


def bucket_start(time: Column, step: int) -> Column:
    """Start of the `step`-second bucket holding `time`; floors on both sides of the origin."""
    seconds = F.unix_seconds(time)
    return F.timestamp_seconds(seconds - seconds_into_bucket(seconds, step))


def bucket_end(time: Column, step: int) -> Column:
    """Label of the bucket holding `time`: its end, so 10:15:00 and 10:15:26 give 10:16:00."""
    seconds = F.unix_seconds(time)
    return F.timestamp_seconds(seconds - seconds_into_bucket(seconds, step) + F.lit(step))


def seconds_into_bucket(seconds: Column, step: int) -> Column:
    return F.pmod(seconds - F.lit(GRID_START_EPOCH), F.lit(step))


def shift(time: Column, seconds: int) -> Column:
    return time + F.make_dt_interval(secs=F.lit(seconds))


def half_open(time: Column, start, end) -> Column:
    """start <= time < end."""
    return (time >= start) & (time < end)


def look_back(time: Column, end: Column, hours: int = 24) -> Column:
    """The half-open slice of the last `hours` before `end`."""
    return half_open(time, shift(end, -3600 * hours), end)


def closed(time: Column, start, end) -> Column:
    """start <= time <= end."""
    return time.between(start, end)


def whole_hours(earlier: Column, later: Column) -> Column:
    """Complete hours from `earlier` to `later`, never negative, days included."""
    return F.greatest(
        F.lit(0).cast("bigint"),
        F.floor((F.unix_seconds(later) - F.unix_seconds(earlier)) / 3600),
    )


def concentrate(time: Column, factor: int, base_epoch: int = GRID_START_EPOCH) -> Column:
    """Squeeze time since `base_epoch` by `factor`, whole seconds."""
    elapsed = F.unix_seconds(time) - F.lit(base_epoch)
    return F.timestamp_seconds(
        F.lit(base_epoch) + F.floor(elapsed / F.lit(factor)).cast("bigint")
    )


def _last_names(path: Column) -> Column:
    """The file's own name, then its folder's (after any "key="): the first dated one counts."""
    folder = F.substring_index(F.substring_index(path, "/", -2), "/", 1)
    return F.concat_ws(
        "/", F.substring_index(path, "/", -1), F.substring_index(folder, "=", -1)
    )


def file_time(path: Column) -> Column:
    """Time in a file name such as temp/2019-10-01-01-00-00-3.csv; NULL where there is none."""
    key = F.regexp_extract(_last_names(path), FILE_NAME_PATTERN, 1)
    return F.try_to_timestamp(key, F.lit(FILE_TIME_FORMAT))


def file_server(path: Column) -> Column:
    """Server number in a file name; NULL where there is none."""
    return F.regexp_extract(_last_names(path), FILE_NAME_PATTERN, 2).try_cast("int")


def file_key(slice_start: Column, server: Column) -> Column:
    """File name stem for one slice and server."""
    return F.concat_ws(
        "-", F.date_format(slice_start, FILE_TIME_FORMAT), server.cast("string")
    )


def check_block(block: str) -> None:
    if block not in BLOCK_FORMATS:
        raise ValueError(f"archive block must be one of {list(BLOCK_FORMATS)}, got {block!r}")


def block_key(time: Column, block: str) -> Column:
    """Archive block of a file time: 2019-10-01-13 for hours, 2019-10-01 for days."""
    check_block(block)
    return F.date_format(time, BLOCK_FORMATS[block])


def block_start(time: Column, block: str) -> Column:
    check_block(block)
    return F.date_trunc(block, time)

"""Keys of clip records: the split that a spelling names, the camera's serial, the recording in a file name."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from marlstone.stages import strip_blanks

#: Spellings of the splits, in lower case without blanks.
SPLITS = {"train": "train training tr", "val": "val valid validation dev development", "test": "test testing tst eval"}
#: Fixed value: a serial.
SERIAL = "T8[A-Z0-9]{6,}"


def split_of(c: Column) -> Column:
    """train, val or test; null for anything else."""
    low = F.lower(strip_blanks(c))
    out = F.when(low.isin(*SPLITS["train"].split()), "train")
    return out.when(low.isin(*SPLITS["val"].split()), "val").when(low.isin(*SPLITS["test"].split()), "test")


def file_name(video_id: Column) -> Column:
    return F.upper(F.regexp_extract(video_id, r"[^/\\]*$", 0))


def serial_of(camera: Column, video_id: Column) -> Column:
    """The serial in ``camera``, however spelled, or else the one in the file name of ``video_id``; null without any."""
    own = F.regexp_extract(F.regexp_replace(F.upper(camera), "[^A-Z0-9]+", ""), SERIAL, 0)
    named = F.regexp_extract(file_name(video_id), rf"(?<![A-Z0-9]){SERIAL}", 0)
    return F.coalesce(F.nullif(own, F.lit("")), F.nullif(named, F.lit("")))


def recording_of(video_id: Column) -> Column:
    """Serial, recording time and number of the file name, whatever separates and follows them; null without them."""
    name = file_name(video_id)
    pattern = rf"(?<![A-Z0-9])({SERIAL})[^A-Z0-9]+([0-9]{{14}})[^A-Z0-9]+([0-9]+)(?![A-Z0-9])"
    part = [F.regexp_extract(name, pattern, i) for i in (1, 2, 3)]
    return F.when(part[0] != "", F.concat_ws("_", *part))


def device_of(video_id: Column) -> Column:
    """The serial in the last part of a path as it is written there, else ``unknown``."""
    found = F.regexp_extract(F.substring_index(video_id, "/", -1), "(T8[A-Za-z0-9]{6,})", 1)
    return F.coalesce(F.nullif(found, F.lit("")), F.lit("unknown"))


def group_key(camera: Column, key: Column) -> Column:
    """The camera, or the record's own key where it is null, empty or ``unknown``."""
    return F.coalesce(F.nullif(F.nullif(camera, F.lit("")), F.lit("unknown")), key)


def shard_file(shard: Column) -> Column:
    """Name of a shard by its number, which must be a whole number; null otherwise."""
    return F.format_string("shard-%06d.tar", shard.try_cast("bigint"))


def member_name(key: Column) -> Column:
    """Name of a record's member in its shard."""
    return F.concat(F.replace(key, F.lit("/"), F.lit("__")), F.lit(".json"))

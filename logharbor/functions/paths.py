"""Names and addresses: files, streams, endpoints, archive objects."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from logharbor.schemas import (
    CHANNELS,
    DEFAULT_API_VERSION,
    DEFAULT_ARCHIVE_PREFIX,
    PAYLOAD_FILE,
)


def file_name(path: Column) -> Column:
    return F.element_at(F.split(path, "/"), -1)


def parse_window_path(files: DataFrame, path: str = "path") -> DataFrame:
    """Add folder, session_id, channel, window_sequence and is_gz from the path of a log
    window ``<folder>/<session>/<channel>.<n>.log[.gz]``; drop other files.

    Readable windows are numbered from 1, without leading zeros.
    """
    name = file_name(F.col(path))
    parts = F.split(F.col(path), "/")
    return (
        files.where(name.rlike(PAYLOAD_FILE))
        .withColumns({
            "folder": F.array_join(F.slice(parts, 1, F.size(parts) - 2), "/"),
            "session_id": F.element_at(parts, -2),
            "channel": F.regexp_extract(name, PAYLOAD_FILE, 1),
            "window_sequence": F.regexp_extract(name, PAYLOAD_FILE, 2).try_cast("bigint"),
            "is_gz": F.regexp_extract(name, PAYLOAD_FILE, 3) != "",
        })
        .where("window_sequence is not null")
    )


def stream_key(session_id: str = "session_id", channel: str = "channel") -> Column:
    return F.concat_ws(".", session_id, channel)


def endpoint_url(host: Column | str, event_type: Column, version: str | None = None) -> Column:
    """``<host>/api/<version>/events/<type>``; one trailing slash of the host is dropped."""
    host = F.lit(host) if isinstance(host, str) else host
    version = version if version and version.strip() else DEFAULT_API_VERSION
    return F.concat(
        F.regexp_replace(host, "/$", ""), F.lit(f"/api/{version}/events/"), event_type
    )


def archive_key(path: Column, prefix: str = DEFAULT_ARCHIVE_PREFIX) -> Column:
    return F.concat(F.lit(prefix), file_name(path))


def archive_keys(files: DataFrame, path: str = "path", prefix: str = DEFAULT_ARCHIVE_PREFIX) -> DataFrame:
    """Add ``archive_key`` and the number of files that share it.

    The key holds the file name only, so equally numbered windows of different sessions
    meet in one object; the count makes that visible.
    """
    keyed = files.withColumn("archive_key", archive_key(F.col(path), prefix))
    counts = keyed.groupBy("archive_key").agg(F.count("*").alias("key_count"))
    from logharbor.operators.skew import lookup

    return lookup(keyed, counts, ["archive_key"], [path])


def is_hidden(name: Column) -> Column:
    return name.startswith(".")


def parse_channels(raw: str | None) -> list[str]:
    """Channels of a comma-separated setting; all of them when it names none."""
    named = [part.strip() for part in (raw or "").split(",")]
    return [part for part in named if part] or list(CHANNELS)


def channel_filter(df: DataFrame, channels: str | list[str] | None) -> DataFrame:
    wanted = channels if isinstance(channels, list) and channels else parse_channels(
        channels if isinstance(channels, str) else None
    )
    return df.where(F.col("channel").isin(wanted))


def configured_channels(df: DataFrame, sources: DataFrame) -> DataFrame:
    """Keep the rows whose channel is configured for their folder."""
    wanted = sources.select("folder", F.explode("log_types").alias("channel")).distinct()
    from logharbor.operators.skew import lookup

    return lookup(df, wanted, ["folder", "channel"], ["session_id"], how="left_semi")

"""Broker records from Python values, and runs over file streams in several batches."""

from __future__ import annotations

import json
from collections import Counter
from datetime import datetime, timedelta

from millrace.schemas import ENVELOPE
from millrace.sources.topics import Broker, read_topic

START = datetime(2024, 1, 1)


def records(spark, values, topic="t", times=None, keys=None, first_offset=0):
    """One record per value; dicts become JSON, ``times`` are seconds after the start."""
    rows = []
    for i, value in enumerate(values):
        text = json.dumps(value) if isinstance(value, (dict, list)) else value
        when = START + timedelta(seconds=times[i] if times else i)
        key = str(keys[i]) if keys else str(i)
        rows.append((bytearray(key.encode()), None if text is None else bytearray(text.encode()),
                     topic if isinstance(topic, str) else topic[i], 0, first_offset + i, when, 0))
    return spark.createDataFrame(rows, ENVELOPE)


def folder_of(frame, path, topic, batches=3):
    """The records as files of a topic, cut into ``batches`` by offset."""
    for i in range(batches):
        frame.where(f"offset % {batches} = {i}").coalesce(1).write.mode("append").parquet(f"{path}/{topic}/part{i}")
    return Broker(folder=str(path))


def stream_of(spark, frame, path, topic, batches=3):
    return read_topic(spark, folder_of(frame, path, topic, batches), topic, max_files=1)


def bag(frame):
    """Rows as a multiset of plain tuples in column-name order."""
    names = sorted(frame.columns)
    return Counter(tuple(map(_hashable, row)) for row in frame.select(*names).collect())


def _hashable(value):
    if isinstance(value, dict):
        return tuple(sorted((k, _hashable(v)) for k, v in value.items()))
    if isinstance(value, (list, tuple)):
        return tuple(map(_hashable, value))
    return value

from __future__ import annotations

import copy
import datetime as dt
import json
import os
import sys
import tempfile
import time

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from eventide.config import builder
    scratch = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    b = builder("local[4]", shuffle_partitions=8)
    session = b.getOrCreate()
    # tests own their session: use a scratch checkpoint folder only if unset
    if not session.sparkContext.getConf().get("spark.checkpoint.dir", None):
        session.sparkContext.setCheckpointDir(os.path.join(scratch, "ckpt"))
    session.sparkContext.setLogLevel("ERROR")
    # collect() shows instants in Python's zone; the JVM keeps the machine's, which
    # must not matter
    os.environ["TZ"] = "UTC"
    time.tzset()
    yield session
    session.stop()


@pytest.fixture()
def scratch():
    return tempfile.mkdtemp(prefix="run-", dir="/tmp")


# a star event (nested)
STAR_EVENT = {
    "id": "91001",
    "type": "WatchEvent",
    "actor": {"id": 7001, "login": "mara-k", "display_login": "mara-k",
              "url": "https://api.example.invalid/users/mara-k",
              "avatar_url": "https://avatars.example.invalid/u/7001"},
    "repo": {"id": 8802, "name": "fjord/lantern",
             "url": "https://api.example.invalid/repos/fjord/lantern"},
    "payload": {"action": "started"},
    "public": True,
    "created_at": "2024-01-02T10:07:00.123456+00:00",
    "collected_at": "2024-01-02T10:08:00.000000+00:00",
}

# a push event whose commits carry languages
PUSH_EVENT = {
    **STAR_EVENT,
    "id": "91002",
    "type": "PushEvent",
    "actor": {k: v for k, v in STAR_EVENT["actor"].items() if k != "display_login"},
    "payload": {"commits": [{"sha": "5e1f0c2a", "message": "Split the lexer",
                             "languages": ["Kotlin", "Elixir"]}]},
}


def event(base=STAR_EVENT, **changes):
    """A copy of ``base`` with dotted-path changes (value None deletes)."""
    e = copy.deepcopy(base)
    for path, v in changes.items():
        parts = path.split("__")
        node = e
        for p in parts[:-1]:
            node = node[p]
        if v is None:
            node.pop(parts[-1], None)
        else:
            node[parts[-1]] = v
    return e


def records(spark, events, key=None):
    """Transport records for a list of event dicts (or raw strings)."""
    rows = [(key, e if isinstance(e, str) else json.dumps(e)) for e in events]
    return spark.createDataFrame(rows, "key string, value string")


def parsed(spark, events):
    from eventide.functions.parse import parse_events
    from eventide.functions.timefilters import ts_lit
    return parse_events(records(spark, events), processed_at=ts_lit("2024-01-31 00:00:00"))


def at(ts: str) -> str:
    return dt.datetime.fromisoformat(ts).strftime("%Y-%m-%dT%H:%M:%S.%f") + "Z"

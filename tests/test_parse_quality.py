from __future__ import annotations

from pyspark.sql import functions as F

from conftest import PUSH_EVENT, STAR_EVENT, event, parsed, records
from eventide.functions.parse import decode, parse_events
from eventide.operators import quality
from eventide.schema import EVENT


def test_event_schema_has_declared_fields():
    names = [f.name for f in EVENT.fields]
    assert names == ["id", "type", "actor", "repo", "payload", "public", "created_at",
                     "org", "collected_at", "languages", "repository_metrics"]


def test_parse_star_event(spark):
    r = parsed(spark, [STAR_EVENT]).collect()[0]
    assert r.id == "91001" and r.type == "WatchEvent"
    assert r.actor.id == 7001 and r.repo.id == 8802 and r.repo.name == "fjord/lantern"
    assert r.payload.action == "started" and r.payload.commits is None
    full = parse_events(records(spark, [STAR_EVENT]), payload="map").collect()[0]
    assert full.payload == {"action": "started"}
    assert str(r.created_at) == "2024-01-02 10:07:00.123456"
    assert r.public is True


def test_binary_records_decode(spark):
    df = records(spark, [STAR_EVENT]).select(
        F.col("key").cast("binary").alias("key"), F.col("value").cast("binary").alias("value"))
    assert decode(df).schema["value"].dataType.simpleString() == "string"
    assert parse_events(df).collect()[0].id == "91001"


def test_malformed_and_bad_timestamp_do_not_fail(spark):
    bad_ts = event(created_at="garbage")
    df = parsed(spark, ["{not json", bad_ts])
    rows = df.collect()
    assert len(rows) == 2
    assert rows[0].id is None and rows[0].actor is None
    assert rows[1].id == "91001" and rows[1].created_at is None


def test_slim_payload_keeps_nested_values_as_text(spark):
    big = event(PUSH_EVENT, payload={"commits": [{"languages": ["Go"]}], "pull_request": {"x": [1, 2]}})
    slim = parsed(spark, [big]).collect()[0].payload
    assert slim.commits == '[{"languages":["Go"]}]'
    full = parse_events(records(spark, [big]), payload="map").collect()[0].payload
    assert set(full) == {"commits", "pull_request"} and full["pull_request"] == '{"x":[1,2]}'


def test_large_actor_id_kept(spark):
    r = parsed(spark, [event(actor__id=5_000_000_000)]).collect()[0]
    assert r.actor.id == 5_000_000_000


def test_validate_lists_missing_fields(spark):
    evs = [STAR_EVENT, event(actor__id=None), event(repo__name=None, created_at=None),
           event(created_at="garbage"), "{nope",
           event(org={"id": 1, "login": "o", "url": "u"})]
    valid, rejected = quality.validate(parsed(spark, evs))
    assert [r.id for r in valid.collect()] == ["91001"]
    errs = sorted((r.id, r.errors) for r in rejected.collect())
    assert ("91001", "actor.id") in errs
    assert ("91001", "repo.name,created_at") in errs
    assert ("91001", "created_at") in errs
    assert ("91001", "org.avatar_url") in errs
    unknown = [e for i, e in errs if i == "unknown"]
    assert unknown and unknown[0].startswith("id,type,actor.id")


def test_unknown_type_kept_and_flagged(spark):
    df = quality.flag_unknown_type(parsed(spark, [STAR_EVENT, event(type="BrandNewEvent")]))
    rows = {r.type: r.known_type for r in df.collect()}
    assert rows == {"WatchEvent": True, "BrandNewEvent": False}
    counts = quality.unknown_type_counts(parsed(spark, [event(type="BrandNewEvent")] * 3))
    assert [(r.event_type, r.event_count) for r in counts.collect()] == [("BrandNewEvent", 3)]


def test_dedup_keeps_first_collected_copy(spark):
    first = event(collected_at="2024-01-02T10:08:00Z")
    again = event(collected_at="2024-01-02T10:20:00Z", public=False)
    other = event(PUSH_EVENT)
    out = quality.dedup(parsed(spark, [again, first, other, again]))
    rows = {r.id: r for r in out.collect()}
    assert len(rows) == 2
    assert rows["91001"].public is True
    assert str(rows["91001"].collected_at) == "2024-01-02 10:08:00"


def test_dedup_hot_key_collapses(spark):
    evs = [event(collected_at=f"2024-01-02T10:{m:02d}:00Z") for m in range(10, 60)]
    out = quality.dedup(parsed(spark, evs + [PUSH_EVENT]))
    rows = {r.id: r for r in out.collect()}
    assert len(rows) == 2 and str(rows["91001"].collected_at) == "2024-01-02 10:10:00"


def test_dedup_ties_keep_one_sent_row(spark):
    # copies collected at the same instant, or at none, that differ in several fields
    same = [event(id="a"), event(id="a", type="ForkEvent", actor__id=2, repo__id=9, public=False),
            event(id="a", actor__id=3, created_at="2024-01-02T10:09:00Z")]
    none = [event(id="b", collected_at=None, type=t, actor__id=k)
            for k, t in enumerate(("PushEvent", "WatchEvent", "ForkEvent"))]
    sent = parsed(spark, same + none)
    kept = quality.dedup(sent)
    assert kept.count() == 2
    assert kept.exceptAll(sent).count() == 0           # each row is one that was sent
    by_id = {r.id: r for r in kept.collect()}
    assert (by_id["a"].type, by_id["a"].actor.id, by_id["a"].public) == ("ForkEvent", 2, False)
    assert (by_id["b"].type, by_id["b"].actor.id) == ("ForkEvent", 2)


def test_collected_at_absent_defaults_unreadable_rejects(spark):
    evs = [event(id="1", collected_at=None), event(id="2", collected_at="soon")]
    valid, rejected = quality.validate(parsed(spark, evs))
    assert [(r.id, str(r.collected_at)) for r in valid.collect()] == [("1", "2024-01-31 00:00:00")]
    assert [(r.id, r.errors) for r in rejected.collect()] == [("2", "collected_at")]

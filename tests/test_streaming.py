"""The stream does what the batch jobs do."""

import json
from datetime import datetime

from fixtures import events, write_all
from sojourn.params import Params
from sojourn.plans import jobs
from sojourn.sources.tables import Warehouse
from sojourn.streaming.events import ingest, read_lines


def test_stream_equals_batch(spark, tmp_path):
    wh = Warehouse(spark, "streamed", str(tmp_path / "warehouse"))
    src = write_all(tmp_path)
    jobs.ingest_users(wh, src["users"])
    jobs.ingest_mentors(wh, src["mentors"])
    inbox = tmp_path / "inbox"
    inbox.mkdir()
    records = events()

    def deliver(name, part):
        (inbox / name).write_text("\n".join(json.dumps(r) for r in part))

    def drain():
        q = ingest(wh, read_lines(spark, str(inbox), 1), str(tmp_path / "ckpt"),
                   params=Params(), as_of=datetime(2025, 8, 1))
        q.awaitTermination()
        assert q.exception() is None

    deliver("a.json", records[:17])
    drain()
    # The same events again, and the rest: each is stored once.
    deliver("b.json", records[10:])
    drain()
    assert wh.read("raw_events").count() == 28
    facts = wh.read("fct_sessions")
    assert facts.count() == 15
    assert facts.filter("is_duration_estimated").count() == 3, "one end came after its start"
    assert len(wh.batches("raw_events")) == 2


def test_batch_and_stream_loads_mix(spark, tmp_path):
    """Batch, stream, batch, stream: every event is paired, as after one load of all."""
    src = write_all(tmp_path)
    records, at = events(), datetime(2025, 8, 1)
    # Whole timelines at a time, since stored facts never change.
    parts = [[r for r in records if int(r["user_id"]) % 4 == k] for k in range(4)]

    def facts(wh):
        return {(r.session_id, r.duration_minutes) for r in wh.read("fct_sessions").collect()}

    def prepared(name):
        wh = Warehouse(spark, name, str(tmp_path / name))
        jobs.ingest_users(wh, src["users"])
        jobs.ingest_mentors(wh, src["mentors"])
        return wh

    whole = prepared("loaded_whole")
    jobs.ingest_events(whole, src["events"])
    jobs.transform(whole, Params(), at)

    mixed = prepared("loaded_mixed")
    for k, part in enumerate(parts):
        if k % 2:
            inbox = tmp_path / f"inbox{k}"
            inbox.mkdir()
            (inbox / "a.json").write_text("\n".join(json.dumps(r) for r in part))
            q = ingest(mixed, read_lines(spark, str(inbox), 1), str(tmp_path / f"ckpt{k}"),
                       params=Params(), as_of=at)
            q.awaitTermination()
            assert q.exception() is None
        else:
            path = tmp_path / f"part{k}.json"
            path.write_text(json.dumps(part))
            jobs.ingest_events(mixed, str(path))
            jobs.transform(mixed, Params(), at)
    assert mixed.read("raw_events").count() == len(records)
    assert facts(mixed) == facts(whole)

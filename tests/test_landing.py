"""Landed files into raw tables and reports."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from teampulse.catalog import fixtures as X
from teampulse.plans import pipeline as P
from teampulse.plans import staging as C
from teampulse.session import scratch_path
from teampulse.sources import landing as L
from teampulse.sources import schemas as S

SF = "/root/testdata/sf0.001"
CUT = dt.datetime(2024, 1, 20)


def rows(df, drop=()):
    cols = sorted(c for c in df.columns if c not in drop)
    return sorted(map(str, df.select(cols).collect()))


def deliver(raw, folder, name, part=None):
    """One delivery of every raw table; feeds and record lists only with the rows of ``part``."""
    for table, df in raw.items():
        path = f"{folder}/{table}/{name}"
        if table == L.ROSTER:
            df.write.option("header", True).option("escape", '"').csv(path)
        else:
            (df.where(part) if part is not None and table in L.APPENDED else df).write.json(path)


def lines(folder, table, delivery, *texts):
    path = f"{folder}/{table}/{delivery}"
    os.makedirs(path, exist_ok=True)
    with open(f"{path}/part-{len(os.listdir(path))}.json", "w") as out:
        out.write("".join(t + "\n" for t in texts))


@pytest.fixture(scope="module")
def raw(spark):
    return X.raw_tables(spark, SF)


def test_landed_files_end_at_the_reports_of_the_raw_tables(spark, raw, tmp_path_factory):
    """A monthly run over one delivery and a weekly run after another give what one run over the raw tables gives."""
    folder, root, whole = str(tmp_path_factory.mktemp("landed")), scratch_path(spark, "landed"), scratch_path(spark, "whole")
    early = F.col(S.EXTRACTED_AT) < F.lit(CUT)
    deliver(raw, folder, "d1", early)
    monthly = P.run_landed(spark, root, folder, CUT.date(), monthly=True)
    assert monthly["monthly_courses"].count() > 0 and monthly["rejected"].count() == 0
    deliver(raw, folder, "d2", ~early)
    lines(folder, "post_liked", "d2", "{broken", '{"id":"x","name":"post.liked","payload":"no"}')
    second = P.run_landed(spark, root, folder, X.AS_OF, spine="calendar")
    full = P.run_weekly(spark, whole, raw, X.AS_OF, spine="calendar")
    for name in ("courses", "rankings", "detail", "businesses_without_managers"):
        assert rows(second[name], ["month"]) == rows(full[name], ["month"]), name
    assert second["rankings"].count() > 0
    drop = ["is_backfill", P.UPDATED]
    assert rows(second["engagement"], drop) == rows(full["engagement"], drop)
    assert sorted(r["reason"] for r in second["rejected"].collect()) == ["not a readable object", "unreadable payload"]
    assert L.unsettled(spark, root) == {}


def test_reasons_and_load_columns(spark, tmp_path):
    folder, root = str(tmp_path / "in"), str(tmp_path / "root")
    good = '{"id":"a","name":"post.liked","payload":{"space":{"id":7}},"created_at":"2024-01-02T03:04:05+0200"}'
    as_text = '{"id":"b","name":"post.liked","payload":"{\\"space\\":{\\"id\\":\\"7\\"}}","created_at":"2024-01-02T03:04:05Z","_airbyte_raw_id":"r"}'
    bad = ["[1, 2]", "7", "not json", '{"id":"c","name":"post.comment.liked"}', '{"name":"post.liked"}', '{"id":"d","name":"post.liked","payload":{"space":1}}']
    lines(folder, "post_liked", "d1", good, "", "   ", as_text, *bad)
    lines(folder, "event_attendees", "d1", '{"id":"x1"}', '{"id":3,"event_id":4}', '{"event_id":4}')
    for table in ("post_liked", "event_attendees", "post_liked"):
        query = L.feed_writer(spark, folder, root, table).start()
        query.awaitTermination()
    kept = {r["id"]: r for r in L.landed_rows(spark, root, "post_liked").collect()}
    assert sorted(kept) == ["a", "b"] and all(r["payload"]["space"]["id"] == "7" for r in kept.values())
    cleaned = C.clean_post_likes(L.landed_rows(spark, root, "post_liked")).select("record_id", F.unix_seconds("created_at")).collect()
    assert dict(map(tuple, cleaned)) == {"a": 1704157445, "b": 1704164645}  # an offset of two hours
    assert kept["a"][S.EXTRACTED_AT] is not None and len(kept["a"][S.RAW_ID]) == 64 and kept["b"][S.RAW_ID] == "r"
    found = {(r["source_table"], r["line"]): r["reason"] for r in L.rejected_rows(spark, root).collect()}
    unreadable = "not a readable object"
    assert [found["post_liked", t] for t in bad] == [unreadable] * 3 + ["another feed", "no id", "unreadable payload"]
    assert found["event_attendees", '{"id":"x1"}'] == unreadable and found["event_attendees", '{"event_id":4}'] == "no id"
    assert [r["id"] for r in L.landed_rows(spark, root, "event_attendees").collect()] == [3]


def test_a_repeated_batch_changes_nothing(spark, tmp_path):
    path = str(tmp_path / "raw" / "post_liked")
    made = [('{"id":"a","name":"post.liked"}', "f", CUT), ("oops", "f", CUT)]
    batch = L.parsed(spark.createDataFrame(made, "value string, file string, landed_at timestamp"), "post_liked")
    for number in (0, 1, 1):
        L.write_batch(batch, number, path)
    assert sorted(r[L.BATCH] for r in L.landed_rows(spark, str(tmp_path), "post_liked").collect()) == [0, 1]
    assert L.rejected_rows(spark, str(tmp_path)).count() == 2


def test_late_files_are_read_from_their_earliest_row(spark, tmp_path):
    folder, root = str(tmp_path / "in"), str(tmp_path / "root")

    def event(i, day):
        return f'{{"id":"{i}","name":"post.liked","created_at":"2024-01-0{day}T00:00:00Z","_airbyte_extracted_at":"2024-01-0{day}T00:00:00Z"}}'

    def take():
        L.feed_writer(spark, folder, root, "post_liked").start().awaitTermination()
        return L.unsettled(spark, root)

    lines(folder, "post_liked", "d1", event("new", 9))
    used = take()
    store, empty = P.Store(spark, root), {t: L.landed_rows(spark, root, t) for t in L.APPENDED}
    P.load_feeds(store, empty | {"post_liked": L.landed_rows(spark, root, "post_liked")})
    L.settle(spark, root, used)
    lines(folder, "post_liked", "d2", event("late", 2))
    used = take()
    assert used == {"post_liked": (1, dt.datetime(2024, 1, 2))} == L.unsettled(spark, root)
    raw = empty | {"post_liked": L.landed_rows(spark, root, "post_liked")}
    done = P.load_feeds(store, raw)["post_likes"]
    assert [r["record_id"] for r in done.collect()] == ["new"]
    done = P.load_feeds(store, raw, late={"post_liked": used["post_liked"][1]})["post_likes"]
    assert sorted(r["record_id"] for r in done.collect()) == ["late", "new"]
    L.settle(spark, root, used)
    assert take() == {}


def test_snapshots_take_the_newest_complete_delivery(spark, tmp_path):
    folder, root = str(tmp_path / "in"), str(tmp_path / "root")
    with pytest.raises(FileNotFoundError):
        L.take_snapshot(spark, folder, root, "community_members")
    for delivery, member in (("d1", 1), ("d2", 2), ("d3", 3)):
        lines(folder, "community_members", delivery, f'{{"community_member_id":{member},"member_tags":[{{"id":"4"}}]}}', "{")
        if delivery != "d3":
            open(f"{folder}/community_members/{delivery}/_SUCCESS", "w").close()
        got = L.take_snapshot(spark, folder, root, "community_members").collect()
        assert [(r["community_member_id"], r["member_tags"]) for r in got] == [(min(member, 2), '[{"id":"4"}]')]
    assert L.tables.folders(spark, f"{root}/raw/community_members") == ["d2"]
    assert [r["line"] for r in L.rejected_rows(spark, root).collect()] == ["{"]


def test_archive_takes_files_that_were_read(spark, tmp_path):
    folder, root, archive = str(tmp_path / "in"), str(tmp_path / "root"), str(tmp_path / "archive")
    for k in range(3):
        lines(folder, "post_liked", f"d{k}", f'{{"id":"{k}","name":"post.liked"}}')
        L.feed_writer(spark, folder, root, "post_liked", archive, files_per_batch=1).start().awaitTermination()
    kept = sorted(r["id"] for r in L.landed_rows(spark, root, "post_liked").collect())
    moved = [f for _, _, files in os.walk(archive) for f in files if f.endswith(".json")]
    left = [f for _, _, files in os.walk(folder) for f in files if f.endswith(".json")]
    assert kept == ["0", "1", "2"] and len(moved) >= 2 and len(moved) + len(left) == 3


def test_cleaned_tables_carry_the_time_of_the_run(raw):
    at = dt.datetime(2024, 1, 31, 7)
    made = {
        "cleaned_at": [C.clean_members(raw["community_members"], X.AS_OF, at), C.clean_events(raw["events_list"], at), C.clean_invited_managers(raw["managers_not_joined"], at)],
        "data_cleaned_at": [C.clean_attendees(raw["event_attendees"], at)],
    }
    for name, frames in made.items():
        for df in frames:
            assert [r[0] for r in df.select(name).distinct().collect()] == [at]
    assert "cleaned_at" not in C.clean_members(raw["community_members"], X.AS_OF).columns

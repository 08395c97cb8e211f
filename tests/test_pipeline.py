"""The load job, the stored tables and the stream."""

import json

import pytest

from duelframe import ConcurrentLoadError, ValidationError, run_pipeline, store_metrics, stored_metrics
from duelframe.plans import pipeline
from duelframe.schemas import CONTEST, ENTITY
from duelframe.sources import commits, landing, tables
from duelframe.streaming import incremental

pytestmark = pytest.mark.usefixtures("interpreted")


def page_frame(spark, *bodies):
    return spark.createDataFrame([(i, json.dumps(b)) for i, b in enumerate(bodies, 1)], landing.PAGE_SCHEMA)


def entity(i, **extra):
    return {"id": i, "name": f"n{i}", "types": "A/B", "hp": i * 10, **extra}


def contest(a, b, w):
    return {"first_pokemon": a, "second_pokemon": b, "winner": w}


LISTING = [[entity(1), entity(2)], {"results": [entity(3), 5, entity(900)]}]
CONTESTS = [{"combats": [contest(1, 2, 1), contest(1, 2, 1), contest(1, 4, 4)]}, [contest(2, 3, 2), contest(3, 900, 3)]]


def run(spark, warehouse, listing=LISTING, contests=CONTESTS, details=None, **options):
    return run_pipeline(
        spark,
        warehouse,
        **{"max_id": 799, **options},
        listing_pages=page_frame(spark, *listing),
        contest_pages=page_frame(spark, *contests),
        detail_pages=None if details is None else page_frame(spark, *details),
    )


def test_load_twice(spark, tmp_path):
    warehouse = str(tmp_path)
    first = run(spark, warehouse)
    e, c = first.entity_report.collect()[0], first.contest_report.collect()[0]
    assert (e.raw, e.out_of_range, e.inserted, e.updated) == (4, 1, 3, 0)
    assert (c.raw, c.out_of_range, c.unknown_entity, c.source_duplicates, c.inserted) == (5, 1, 1, 1, 2)
    assert first.entities.schema.names == ENTITY.names and first.contests.schema.names == CONTEST.names
    again = run(spark, warehouse)
    e, c = again.entity_report.collect()[0], again.contest_report.collect()[0]
    assert (e.inserted, e.updated, c.inserted, c.already_present) == (0, 3, 0, 2)
    assert sorted(tuple(r) for r in again.contests.collect()) == [(1, 2, 1), (2, 3, 2)]
    kept = store_metrics(spark, warehouse)
    assert sorted(map(repr, kept.collect())) == sorted(map(repr, stored_metrics(spark, warehouse).collect()))
    found = {r.entity_id: (r.type_1, r.type_2, r.hp, r.total_battles, r.total_wins) for r in stored_metrics(spark, warehouse).collect()}
    assert found == {1: ("A", "B", 10, 1, 1), 2: ("A", "B", 20, 2, 1), 3: ("A", "B", 30, 1, 0)}


def test_reload_without_a_field_clears_it(spark, tmp_path):
    run(spark, str(tmp_path))
    bare = {"id": 1, "name": "n1"}
    after = run(spark, str(tmp_path), listing=[[bare, {**bare, "name": "last"}]])
    rows = {r.entity_id: (r.name, r.hp) for r in after.entities.collect()}
    assert rows == {1: ("last", None), 2: ("n2", 20), 3: ("n3", 30)}
    assert after.entity_report.collect()[0].source_duplicates == 1


def test_details_replace_the_listing(spark, tmp_path):
    found = run(spark, str(tmp_path / "a"), details=[[entity(1, hp=77)], [entity(8)]])
    assert [(r.entity_id, r.hp) for r in found.entities.collect()] == [(1, 77)]
    found = run(spark, str(tmp_path / "b"), details=[[entity(8)]])
    assert sorted(r.entity_id for r in found.entities.collect()) == [1, 2, 3]


def test_what_is_not_committed_is_not_read(spark, tmp_path, monkeypatch):
    warehouse = str(tmp_path)
    run(spark, warehouse)
    before = [sorted(map(repr, read(spark, warehouse).collect())) for read in (tables.read_entities, tables.read_contests, tables.read_counts)]

    def broken(*args):
        raise OSError("lost")

    with monkeypatch.context() as m:  # rows and counts are written by then
        m.setattr(tables.commits, "commit", broken)
        with pytest.raises(OSError):
            pipeline.load_contests(spark, spark.createDataFrame([(3, 1, 1), (3, 2, 2)], CONTEST), warehouse)
        with pytest.raises(OSError):
            run(spark, warehouse, listing=[[entity(1, hp=5), entity(7)]])
    assert len(list((tmp_path / "contests").glob("add-*"))) == 2
    assert [sorted(map(repr, read(spark, warehouse).collect())) for read in (tables.read_entities, tables.read_contests, tables.read_counts)] == before


def test_the_second_of_two_writers_fails_and_a_load_tries_again(spark, tmp_path, monkeypatch):
    warehouse = str(tmp_path)
    run(spark, warehouse)
    at = tables.contest_batches(spark, warehouse)
    tables.change_contests(spark, warehouse, at, spark.createDataFrame([(3, 1, 1)], CONTEST))
    with pytest.raises(ConcurrentLoadError):
        tables.change_contests(spark, warehouse, at, spark.createDataFrame([(3, 1, 1)], CONTEST))
    real, late = tables.contest_batches, [tables.contest_batches(spark, warehouse)]
    other = spark.createDataFrame([(3, 2, 2), (2, 1, 1)], CONTEST)
    tables.change_contests(spark, warehouse, late[0], spark.createDataFrame([(3, 2, 2)], CONTEST))
    monkeypatch.setattr(tables, "contest_batches", lambda *a: late.pop() if late else real(*a))
    report = pipeline.load_contests(spark, other, warehouse).collect()[0]  # began before the other's commit
    assert (report.inserted, report.already_present) == (1, 1)
    found = sorted(tuple(r) for r in tables.read_contests(spark, warehouse).collect())
    assert found == [(1, 2, 1), (2, 1, 1), (2, 3, 2), (3, 1, 1), (3, 2, 2)]


def test_a_name_that_is_taken_is_not_replaced(spark, tmp_path, monkeypatch):
    table = str(tmp_path / "t")
    for folder in "ab":
        commits.commit(spark, table, commits.newest(spark, table), [{"folder": folder}])
    before = commits.newest(spark, table)
    (tmp_path / "t" / "commit-0000000003").write_text('[{"folder": "other"}]')
    monkeypatch.setattr(commits, "_numbers", lambda *a: [1, 2])  # the other writer came in just now
    with pytest.raises(ConcurrentLoadError):
        commits.commit(spark, table, before, [{"folder": "c"}])
    monkeypatch.undo()
    assert commits.newest(spark, table).entries == ({"folder": "other"},)
    assert sorted(f.name for f in (tmp_path / "t").iterdir() if "crc" not in f.name) == ["commit-0000000001", "commit-0000000002", "commit-0000000003"]


def test_empty_inputs(spark, tmp_path):
    assert tables.read_contests(spark, str(tmp_path)).count() == 0
    found = run(spark, str(tmp_path), contests=[[]])
    assert found.contests.count() == 0 and found.contest_report.collect()[0].raw == 0
    with pytest.raises(ValidationError):
        stored_metrics(spark, str(tmp_path))


def test_page_readers(spark, tmp_path):
    for i, body in enumerate(LISTING, 1):
        (tmp_path / f"page_{i}.json").write_text(json.dumps(body, indent=1))
    files = landing.read_page_files(spark, str(tmp_path))
    assert sorted(r.page for r in files.collect()) == [1, 2]
    assert landing.records(landing.page_items(files)).count() == 4
    lines = str(tmp_path / "lines")
    page_frame(spark, *LISTING).write.json(lines)
    assert landing.records(landing.page_items(landing.read_page_lines(spark, lines))).count() == 4


def test_table_scan_projection_and_mapper(spark, tmp_path):
    run(spark, str(tmp_path))
    path = f"{tmp_path}/entities/{tables.entity_ranges(spark, str(tmp_path)).entries[0]['folder']}"
    df = tables.read_table(spark, path, ENTITY, ["entity_id", "hp"], lambda d: d.filter("hp > 10"))
    assert df.columns == ["entity_id", "hp"] and df.count() == 2


def test_stream_picks_up_what_came_since(spark, tmp_path):
    warehouse, landed, checkpoint = (str(tmp_path / n) for n in ("warehouse", "landed", "checkpoint"))
    raw = landing.raw_entities(landing.records(landing.page_items(page_frame(spark, *LISTING))))
    pipeline.load_entities(spark, raw, warehouse, max_id=799)

    def land(*bodies):
        page_frame(spark, *bodies).write.mode("append").json(landed)
        pages = incremental.stream_pages(spark, landed, max_files=1)
        incremental.append_stream(pages, warehouse, checkpoint, max_id=799).awaitTermination()
        return sorted(tuple(r) for r in tables.read_contests(spark, warehouse).collect())

    assert land(*CONTESTS) == [(1, 2, 1), (2, 3, 2)]
    assert land([contest(1, 2, 1), contest(3, 1, 1)]) == [(1, 2, 1), (2, 3, 2), (3, 1, 1)]
    # (1, 4, 4) landed before entity 4, and is loaded with it.
    late = landing.raw_entities(landing.records(landing.page_items(page_frame(spark, [entity(4)]))))
    pipeline.load_entities(spark, late, warehouse)
    assert (1, 4, 4) in [tuple(r) for r in tables.read_contests(spark, warehouse).collect()]
    assert land([3, {"x": 1}]) == [(1, 2, 1), (1, 4, 4), (2, 3, 2), (3, 1, 1)]
    aside = tables.read_quarantine(spark, warehouse).collect()
    assert [(r.source, r.reason, r.text) for r in aside] == [("contests", landing.NOT_AN_OBJECT, "3")]


def test_nothing_is_lost_by_default(spark, tmp_path):
    found = run(spark, str(tmp_path), max_id=None)
    assert sorted(r.entity_id for r in found.entities.collect()) == [1, 2, 3, 900]
    assert sorted(tuple(r) for r in found.contests.collect()) == [(1, 2, 1), (2, 3, 2), (3, 900, 3)]
    assert [tuple(r) for r in found.quarantine_report.collect()] == [("listing", landing.NOT_AN_OBJECT, 1)]
    waiting = [tuple(r) for r in tables.read_waiting(spark, str(tmp_path)).collect()]
    assert waiting == [(1, 4, 4, 4)]


def test_limits_take_the_first_records(spark, tmp_path):
    found = run(spark, str(tmp_path), max_id=None, max_entities=2, max_records=1)
    assert sorted(r.entity_id for r in found.entities.collect()) == [1, 2]
    assert [tuple(r) for r in found.contests.collect()] == [(1, 2, 1)]


def test_nameless_entities_are_set_aside_and_counted(spark, tmp_path):
    raw = spark.createDataFrame([(1, "a", True), (2, None, False), (None, None, True)], "id int, name string, legendary boolean")
    report = pipeline.load_entities(spark, raw, str(tmp_path)).collect()[0]
    assert (report.raw, report.out_of_range, report.unnamed, report.inserted) == (3, 1, 1, 1)
    assert [r.entity_id for r in tables.read_entities(spark, str(tmp_path)).collect()] == [1]
    aside = tables.read_quarantine(spark, str(tmp_path)).collect()
    assert [(r.source, r.reason) for r in aside] == [("entities", pipeline.NO_NAME)] and '"entity_id":2' in aside[0].text


def test_folders_do_not_pile_up(spark, tmp_path):
    for _ in range(4):
        run(spark, str(tmp_path))
    assert len(list((tmp_path / "entities").glob("rows-*/part=*"))) == commits.KEPT
    assert not list((tmp_path / "batches").glob("*"))
    before = sorted(tuple(r) for r in tables.read_contests(spark, str(tmp_path)).collect())
    tables.compact_contests(spark, str(tmp_path))
    assert sorted(tuple(r) for r in tables.read_contests(spark, str(tmp_path)).collect()) == before == [(1, 2, 1), (2, 3, 2)]


def test_scratch_folder_uses_the_shared_setting(spark):
    shared = spark.sparkContext.getConf().get("spark.checkpoint.dir")
    assert tables.scratch_folder(spark, "x").startswith(f"{shared}/x-")


def test_pages_are_parsed_once(spark, tmp_path, monkeypatch):
    plans, real = [], tables.set_aside

    def watched(rows, *rest):
        plans.append(rows._jdf.queryExecution().optimizedPlan().toString().replace("_", "").lower())
        real(rows, *rest)

    monkeypatch.setattr(tables, "set_aside", watched)
    result = run(spark, str(tmp_path), details=[[entity(1), 7], {"detail": "none"}])
    assert len(plans) == 4 and not any("parsejson" in p for p in plans)
    counts = {(r.source, r.reason): r.n for r in result.quarantine_report.collect()}
    assert counts == {("listing", landing.NOT_AN_OBJECT): 1, ("details", landing.NOT_AN_OBJECT): 1, ("details", landing.NO_RECORDS): 1}

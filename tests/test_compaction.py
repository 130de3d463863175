"""Compaction of batches, CSV copies that failed, and the index of files."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from wardlake.plans import inputs
from wardlake.sources import file_index, lake
from wardlake.streaming import ingest

JUNE = dt.datetime(2024, 6, 3, tzinfo=dt.timezone.utc)
JULY = dt.datetime(2024, 7, 3, tzinfo=dt.timezone.utc)
SCHEMA = "record_id bigint, county string, note string"


def records(spark, n, start=0):
    return spark.createDataFrame([(start + i, f'C"{i % 3}, x', None if i % 2 else "n") for i in range(n)], SCHEMA).coalesce(1)


def fill(spark, base, **options):
    for batch in range(2):
        ingest.write_batch(records(spark, 10, 10 * batch), batch, base, JUNE, error_count=batch)
    ingest.write_batch(records(spark, 10, 50), "a7", base, JULY, **options)
    ingest.write_batch(records(spark, 10, 60), "07", base, JULY)


def held(spark, base, fmt="json"):
    rows = ingest.read_batches(spark, base, fmt, records(spark, 1).schema)
    return sorted((r.record_id, r.county, r.note, r.year, r.month) for r in rows.collect())


def local(path):
    return path.removeprefix("file:")


def test_compaction_keeps_every_record_once(spark, folder):
    fill(spark, folder)
    before = held(spark, folder)
    assert held(spark, folder, "csv") == before and len(before) == 40
    assert ingest.compact(spark, folder) == 4
    assert held(spark, folder) == before
    assert held(spark, folder, "csv") == before
    manifest = ingest.read_manifest(spark, folder).orderBy("json_path").collect()
    assert [(m.record_count, m.error_count, m.csv_saved) for m in manifest] == [(20, 1, True), (20, 0, True)]
    assert lake.load_raw(spark, f"{folder}/raw", records(spark, 1).schema).count() == 40
    # what is compacted is compacted again with what came since
    ingest.write_batch(records(spark, 5, 100), 9, folder, JUNE)
    assert ingest.compact(spark, folder) == 2
    assert ingest.compact(spark, folder) == 0
    assert len(held(spark, folder)) == 45


def test_a_compaction_that_died_changes_nothing(spark, folder, monkeypatch):
    fill(spark, folder)
    before = held(spark, folder)
    monkeypatch.setattr(ingest, "manifest_folder", lambda base: (_ for _ in ()).throw(RuntimeError("lost")))
    with pytest.raises(RuntimeError):
        ingest.compact(spark, folder)
    monkeypatch.undo()
    assert held(spark, folder) == before == held(spark, folder, "csv")
    assert lake.load_raw(spark, f"{folder}/raw", records(spark, 1).schema).count() == 40


def test_only_small_batches_are_compacted(spark, folder):
    fill(spark, folder)
    ingest.write_batch(records(spark, 40, 200), 8, folder, JUNE)
    assert ingest.compact(spark, folder, least_records=20) == 4
    ids = {r.batch_id.split("-")[0] for r in ingest.read_manifest(spark, folder).collect()}
    assert ids == {"8", "compact"}
    assert len(held(spark, folder)) == 80


def test_batches_without_records_and_retries(spark, folder):
    ingest.write_batch(records(spark, 0), 1, folder, JUNE, error_count=3)
    ingest.write_batch(records(spark, 0), 2, folder, JUNE, error_count=4)
    assert ingest.compact(spark, folder) == 2
    row = ingest.read_manifest(spark, folder).first()
    assert (row.record_count, row.error_count) == (0, 7)


def test_replaced_folders_are_removed(spark, folder):
    fill(spark, folder)
    before = held(spark, folder)
    ingest.compact(spark, folder)
    assert ingest.remove_replaced(spark, folder, dt.datetime(2020, 1, 1)) == 0
    assert ingest.remove_replaced(spark, folder, dt.datetime.now() + dt.timedelta(days=1)) == 4
    assert held(spark, folder) == before == held(spark, folder, "csv")
    below = local(f"{folder}/raw/json/year=2024/month=06")
    assert [n.split("=")[1].split("-")[0] for n in os.listdir(below)] == ["compact"]
    assert len(ingest.read_manifest(spark, folder).collect()) == 2


def test_a_failed_csv_copy_is_read_from_json(spark, folder):
    fill(spark, folder, formats=("json",))
    assert held(spark, folder, "csv") == held(spark, folder)
    ingest.compact(spark, folder)  # July has no whole set of CSV copies
    saved = sorted((r.record_count, r.csv_saved) for r in ingest.read_manifest(spark, folder).collect())
    assert saved == [(20, False), (20, True)]
    assert held(spark, folder, "csv") == held(spark, folder) and len(held(spark, folder)) == 40


def test_a_csv_write_that_fails_leaves_the_json_copy(spark, folder, monkeypatch):
    def fails(*args):
        raise OSError("disk")

    monkeypatch.setattr(ingest, "export_csv", fails)
    ingest.write_batch(records(spark, 4), 0, folder, JUNE)
    monkeypatch.undo()
    ingest.write_batch(records(spark, 4, 4), 1, folder, JUNE)
    assert len(held(spark, folder, "csv")) == 8


def test_a_csv_lake_with_a_lost_batch_is_refused(spark, folder):
    ingest.write_batch(records(spark, 4), 0, folder, JUNE, formats=("csv",))
    ingest.write_batch(records(spark, 4, 4), 1, folder, JUNE, formats=("json",))
    index = [f"{folder}/raw/csv", f"{folder}/raw/manifest"]
    for n, path in enumerate(index):  # a lake whose JSON zone is gone
        name = path.rsplit("/", 1)[1]
        os.makedirs(local(f"{folder}/copy/raw"), exist_ok=True)
        os.symlink(local(path), local(f"{folder}/copy/raw/{name}"))
    with pytest.raises(FileNotFoundError, match="neither"):
        lake.load_raw(spark, f"{folder}/copy/raw", records(spark, 1).schema)


# -- index of files


def sizes(df):
    return {local(r.path): r.length for r in df.select("path", "length").collect()}


def on_disk(base):
    found = {}
    for path, _, names in os.walk(local(base)):
        for name in names:
            # Spark lists no files without bytes
            hidden = not os.path.getsize(os.path.join(path, name)) or any(part[:1] in "._" for part in os.path.join(path, name).removeprefix(local(base)).split("/") if part)
            if not hidden:
                found[os.path.join(path, name)] = os.path.getsize(os.path.join(path, name))
    return found


def test_ingest_keeps_the_index(spark, folder, monkeypatch):
    fill(spark, folder)
    ingest.compact(spark, folder)
    base = f"{folder}/raw"
    assert sizes(file_index.read_index(spark, base)) == on_disk(base)
    listed = []
    monkeypatch.setattr(file_index, "list_files", lambda *args: listed.append(args))
    assert lake.has_enough_data(spark, base, 5)
    inventory = {(r.zone, r.format): (r.files, r.bytes) for r in lake.lake_inventory(spark, base).collect()}
    assert inventory["json", "json"][1] == sum(n for p, n in on_disk(base).items() if "/raw/json/" in p)
    assert lake.load_raw(spark, base, records(spark, 1).schema).count() == 40
    assert lake.pick_main_file(spark, base).count() == 1
    assert not listed


def test_refresh_finds_what_came_and_went(spark, folder):
    ingest.write_batch(records(spark, 10), 1, folder, JUNE)
    base = f"{folder}/raw"
    records(spark, 5).coalesce(1).write.json(f"{base}/dropped")
    gone = next(p for p in on_disk(base) if "/raw/csv/" in p)
    os.remove(gone)
    assert file_index.refresh(spark, base) == 2
    assert sizes(file_index.read_index(spark, base)) == on_disk(base)
    assert file_index.refresh(spark, base) == 0
    ingest.write_batch(records(spark, 3, 500), 70, folder, JULY)
    assert sizes(file_index.read_index(spark, base)) == on_disk(base)
    assert file_index.refresh(spark, base) == 0


def test_a_listing_without_its_marker_does_not_count(spark, folder):
    ingest.write_batch(records(spark, 3), 1, folder, JUNE)
    base = f"{folder}/raw"
    known = sizes(file_index.read_index(spark, base))
    rows = spark.createDataFrame([("file:/x", 1, None, 1)], file_index.ROW)
    rows.write.parquet(f"{base}/{file_index.INDEX_FOLDER}/bases/base-9")
    assert sizes(file_index.read_index(spark, base)) == known == on_disk(base)


def test_without_an_index_the_folder_is_listed(spark, folder):
    records(spark, 5).coalesce(1).write.json(f"{folder}/a")
    assert file_index.read_index(spark, folder) is None
    assert sizes(file_index.files_below(spark, folder)) == on_disk(folder)
    assert file_index.refresh(spark, folder) == len(on_disk(folder))
    assert sizes(file_index.files_below(spark, folder)) == on_disk(folder)


def test_packed_batches_are_compacted_as_packed_files(spark, folder):
    for batch in range(2):
        ingest.write_batch(records(spark, 10, 10 * batch), batch, folder, JUNE, compression="gzip")
    before = held(spark, folder)
    assert ingest.compact(spark, folder, compression="gzip") == 2
    assert held(spark, folder) == before == held(spark, folder, "csv") and len(before) == 20
    assert lake.load_raw(spark, f"{folder}/raw", records(spark, 1).schema).count() == 20
    names = [name for _, _, names in os.walk(local(f"{folder}/raw")) for name in names if "/manifest/" not in name]
    assert not [n for n in names if n.endswith(".csv")] and [n for n in names if n.endswith(".json.gz")]
    # an inventory goes by the format of the contents
    formats = {(r.zone, r.format) for r in lake.lake_inventory(spark, f"{folder}/raw").collect()}
    assert formats == {("csv", "csv"), ("json", "json"), ("manifest", "json")}


def test_the_registered_compaction_takes_less_room_than_its_records(spark, sf_dir):
    for base in inputs.compacted(spark, sf_dir).values():
        sizes = file_index.files_below(spark, f"{base}/raw").collect()
        assert not [f.path for f in sizes if f.path.endswith(".csv") or "/raw/json/" in f.path and f.path.endswith(".json")]

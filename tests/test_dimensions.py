"""Dictionary and embedding files: one large object in byte ranges, bounded objects, broken files."""

import json
import os
import random

import pytest

from ripplerec.sources.dimensions import read_embeddings, read_id_map, write_embeddings, write_id_map


def _rows(df):
    return sorted((r["kind"], r["id"], tuple(r["vec"])) for r in df.collect())


def _want(matrices):
    return sorted((k, i, tuple(v)) for k, m in matrices.items() for i, v in enumerate(m))


@pytest.fixture()
def small_ranges(spark):
    """Byte ranges of a few hundred bytes, so that one small file is cut often."""
    keys = {"spark.sql.files.maxPartitionBytes": "700", "spark.sql.files.openCostInBytes": "1"}
    old = {k: spark.conf.get(k) for k in keys}
    for k, v in keys.items():
        spark.conf.set(k, v)
    yield
    for k, v in old.items():
        spark.conf.set(k, v)


@pytest.mark.parametrize("style", ["compact", "indented", "spaced"])
def test_one_large_object_is_read_in_byte_ranges(spark, tmp_path, small_ranges, style):
    rng = random.Random(1)
    m = {"user": [[rng.randrange(-99, 99) / 4 for _ in range(3)] for _ in range(400)],
         "item": [[rng.randrange(-99, 99) / 4 for _ in range(3)] for _ in range(150)]}
    text = json.dumps(m, separators=(",", ":") if style == "compact" else (" , ", " : ") if style == "spaced" else None,
                      indent=1 if style == "indented" else None)
    (tmp_path / "e.json").write_text(text)
    df = read_embeddings(spark, str(tmp_path / "e.json"))
    assert _rows(df) == _want(m)
    assert spark.read.text(str(tmp_path / "e.json")).rdd.getNumPartitions() > 5
    assert _rows(read_embeddings(spark, str(tmp_path / "e.json"), "item")) == _want({"item": m["item"]})


def test_positions_go_on_over_objects_and_files(spark, tmp_path, small_ranges):
    folder = tmp_path / "f"
    folder.mkdir()
    (folder / "a.json").write_text('{"user": [[1.0], [2.0]], "item": [[9.0]]}\n{"item": [[8.0]], "user": [[3.0]]}')
    (folder / "b.json").write_text('{"item": [[7.0], [6.0]]}\n')
    (folder / "c.json").write_text('{"user": [], "item": [[5.0]]}')
    assert _rows(read_embeddings(spark, str(folder))) == _want(
        {"user": [[1.0], [2.0], [3.0]], "item": [[9.0], [8.0], [7.0], [6.0], [5.0]]})


def test_written_objects_hold_bounded_ranges(spark, tmp_path):
    rng = random.Random(2)
    users = {i: [float(rng.randrange(100)), float(i)] for i in rng.sample(range(1000), 700)} | {999: [1.0, 2.0]}
    items = {i: [float(i), 0.5] for i in range(60)}
    frame = lambda d: spark.createDataFrame(list(d.items()), "id int, vec array<float>")
    write_embeddings(frame(users), frame(items), str(tmp_path / "e"), 2, rows_per_object=128)
    sizes = []
    for f in os.listdir(tmp_path / "e"):
        if f.endswith(".txt"):
            for line in (tmp_path / "e" / f).read_text().splitlines():
                (_, matrix), = json.loads(line).items()
                sizes.append(len(matrix))
    assert max(sizes) <= 128 and sum(sizes) == 1060 and len(sizes) == 9
    got = _rows(read_embeddings(spark, str(tmp_path / "e")))
    assert got == _want({"user": [users.get(i, [0.0, 0.0]) for i in range(1000)], "item": [items[i] for i in range(60)]})


def test_one_large_map_is_read_in_byte_ranges(spark, tmp_path, small_ranges):
    m = {str(i * 7 - 100): i for i in range(900)}
    for name, text in (("a", json.dumps(m)), ("b", json.dumps(m, indent=2)), ("c", json.dumps(m, separators=(",", ":")))):
        (tmp_path / name).write_text(text)
        assert {str(r.raw_id): r.dense_id for r in read_id_map(spark, str(tmp_path / name)).collect()} == m
    (tmp_path / "empty").write_text("{}")
    assert read_id_map(spark, str(tmp_path / "empty")).count() == 0
    ids = spark.createDataFrame([(int(k), v) for k, v in m.items()], "raw_id long, dense_id int")
    write_id_map(ids, str(tmp_path / "parts"), rows_per_part=100)
    assert {str(r.raw_id): r.dense_id for r in read_id_map(spark, str(tmp_path / "parts")).collect()} == m


@pytest.mark.parametrize("text", ['{"1": 2, "3": 4', '{"1": 2, "x": 4}', "", "1,2,3", '{"1": "a"}'])
def test_a_broken_map_fails(spark, tmp_path, text):
    (tmp_path / "m").write_text(text or " ")
    with pytest.raises(Exception, match="not a JSON object"):
        read_id_map(spark, str(tmp_path / "m")).collect()


@pytest.mark.parametrize("text", ['{"user": [[1.0], [2.0]', "[[1.0]]", '{"user": [[1.0]], oops}', '{"user": [[1.0, x]]}', "{[[1.0]]}"])
def test_a_broken_matrix_fails(spark, tmp_path, text):
    (tmp_path / "m").write_text(text)
    with pytest.raises(Exception):
        read_embeddings(spark, str(tmp_path / "m")).collect()

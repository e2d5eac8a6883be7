import json

import pytest
from conftest import rows
from cohortloom.operators import signals
from cohortloom.sources import cohort_files as files

HEADER = "r1 2 100 4\n\n r1.mat 16 50/uV 16 10 60 210 0 Fz\nr1.mat 16 25/uV 16 -5 x 20 0 Cz\n"


@pytest.fixture()
def cohort(tmp_path):
    for name, index in {
        "b1": "Hour\tTime\tQuality\tRecord\n1\t0:30\t0.5\tr1\n\n2\t\t0.75\tnan\n",
        "a2": "Record\tHour\nr9\tnan",
    }.items():
        folder = tmp_path / name
        folder.mkdir()
        (folder / f"{name}.txt").write_text(f"Patient: {name}\nAge: 3")
        (folder / f"{name}.tsv").write_text(index)
    (tmp_path / "b1" / "r1.hea").write_text(HEADER)
    return str(tmp_path)


def test_reads_a_folder(spark, cohort):
    assert [r.entity_id for r in files.list_entities(spark, cohort).collect()] == ["a2", "b1"]
    assert rows(files.read_entity_text(spark, cohort)) == [
        ("a2", "Patient: a2\nAge: 3"),
        ("b1", "Patient: b1\nAge: 3"),
    ]
    index = files.read_recording_index(spark, cohort)
    assert index.columns == ["entity_id", "seq", "hour", "time", "quality", "record_id"]
    assert rows(index) == [
        ("a2", 0, None, None, None, "r9"),
        ("b1", 0, 1.0, "0:30", 0.5, "r1"),
        ("b1", 1, 2.0, None, 0.75, None),
    ]


def test_reads_headers(spark, cohort):
    headers = files.read_record_headers(spark, cohort)
    parsed = signals.parse_record_headers(headers).orderBy("position").collect()
    assert [(r.entity_id, r.record_id, r.channel) for r in parsed] == [
        ("b1", "r1", "Fz"),
        ("b1", "r1", "Cz"),
    ]
    first, second = parsed
    assert (first.num_signals, first.sampling_frequency, first.num_samples) == (2, 100.0, 4)
    assert (first.gain, first.adc_offset, first.initial_value, first.checksum) == (50, 10, 60, 210)
    assert (second.gain, second.adc_offset, second.initial_value) == (25.0, -5, None)


def test_index_round_trip_keeps_order(spark, tmp_path):
    index = spark.createDataFrame(
        [("e", s, float(9 - s), "1:00", 0.5, f"r{s}" if s % 2 else None) for s in range(9)],
        "entity_id string, seq int, hour double, time string, quality double, record_id string",
    )
    root = str(tmp_path / "out")
    files.write_recording_index(index.repartition(4), root)
    assert rows(files.read_recording_index(spark, root)) == rows(index)


def test_label_map_of_one_object(spark, tmp_path):
    (tmp_path / "m.json").write_text(
        '{"a": 1, "b": "2", "c": null, "d": true, "e": NaN, "f": -2.5, "g\\"x": 3e1}'
    )
    got = files.read_label_map(spark, str(tmp_path), layout="object")
    assert rows(got) == sorted(
        [("a", 1.0), ("d", 1.0), ("e", None), ("f", -2.5), ('g"x', 30.0)], key=repr
    )


@pytest.mark.parametrize("written", [True, False])
def test_odd_entity_names(spark, tmp_path, written):
    names = ["a b", "x=y", "_u", ".y", "p+q", "100%", "é", *(["a:b"] if written else [])]
    root = tmp_path / "cohort"
    if written:
        texts = spark.createDataFrame([(n, "Age: 1") for n in names], "entity_id string, text string")
        files.write_entity_text(texts, str(root))
    else:
        for n in names:
            (root / n).mkdir(parents=True)
            (root / n / "t.txt").write_text("Age: 1")
    assert {r.entity_id for r in files.read_entity_text(spark, str(root)).collect()} == set(names)
    assert {r.entity_id for r in files.list_entities(spark, str(root)).collect()} == set(names)


def test_label_map_keys_and_missing_labels(spark, tmp_path):
    labels = spark.createDataFrame([("é", 1.0), ('a"b', 2.0), ("c", None)], "entity_id string, label double")
    files.write_label_map(labels, str(tmp_path / "m"))
    assert rows(files.read_label_map(spark, str(tmp_path / "m"))) == [('a"b', 2.0), ("é", 1.0)]
    assert spark.read.json(str(tmp_path / "m")).count() == 3
    (tmp_path / "o").mkdir()
    (tmp_path / "o" / "one.json").write_text('{"\\u00e9": 1, "a\\"b": 2}')
    got = files.read_label_map(spark, str(tmp_path / "o"), layout="object")
    assert rows(got) == [('a"b', 2.0), ("é", 1.0)]


def test_label_object_is_split_and_ordered(spark, tmp_path):
    names = ["a", "b,c", 'd"e', "f\\", "g\\,", '","', "h: 1,", "é", "{,}", *(f"n{i:04d}" for i in range(3000))]
    wanted = {n: float(i) for i, n in enumerate(names)}
    labels = [*wanted.items(), ("none", None), (None, 1.0), ("a", -5.0)]
    df = spark.createDataFrame(labels, "entity_id string, label double").repartition(7)
    path = tmp_path / "object"
    # So few rows would be put into one part.
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    files.write_label_object(df, str(path))
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    parts = sorted(path.glob("part-*"))
    assert len(parts) > 1
    whole = json.loads("".join(p.read_text() for p in parts))
    assert whole == {**wanted, "none": None} and list(whole) == sorted(whole)
    assert rows(files.read_label_map(spark, str(path), layout="object")) == rows_of(wanted)
    # One file in one line, read by many tasks that cut it anywhere; a repeated name counts last.
    (tmp_path / "one").mkdir()
    text = json.dumps({"a": "early", "n0001": 77.0})[:-1] + ", " + json.dumps(wanted)[1:]
    (tmp_path / "one" / "m.json").write_text(text)
    size = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "1000")
        assert spark.read.text(str(tmp_path / "one")).rdd.getNumPartitions() > 20
        assert rows(files.read_label_map(spark, str(tmp_path / "one"), layout="object")) == rows_of(wanted)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)


def test_empty_label_object(spark, tmp_path):
    df = spark.createDataFrame([], "entity_id string, label double")
    files.write_label_object(df, str(tmp_path / "object"))
    assert json.loads("".join(p.read_text() for p in sorted((tmp_path / "object").glob("part-*")))) == {}
    assert files.read_label_map(spark, str(tmp_path / "object"), layout="object").collect() == []


def rows_of(labels):
    return sorted(labels.items(), key=repr)


def test_folders_are_those_of_sparks_writer(spark, tmp_path, monkeypatch):
    names = ["a b", 'q"#%\'*/:=?\\{[]^', "\x01\t\n\x1f\x7f}|<>", "é", "twice", "twice", "", None, "no text"]
    texts = [(n, None if n == "no text" else f"Age: {i}\né\r") for i, n in enumerate(names)]
    df = spark.createDataFrame(texts, "entity_id string, text string")
    with monkeypatch.context() as patch:
        patch.setattr(files, "_local_path", lambda spark, root: None)
        files.write_entity_text(df, str(tmp_path / "by_spark"))
    writer = type(df.write)
    with monkeypatch.context() as patch:
        # Spark's writer starts a process for every file of a mounted folder.
        patch.setattr(writer, "text", lambda *_, **__: pytest.fail("one process per entity"))
        files.write_entity_text(df, f"file://{tmp_path}/direct")

    def held(root):
        found = {}
        for file in root.glob("*/*.txt"):
            found.setdefault(file.parent.name, []).append(sorted(file.read_bytes().split(b"\n")))
        return {name: sorted(parts) for name, parts in found.items()}

    assert held(tmp_path / "direct") == held(tmp_path / "by_spark")
    assert not list((tmp_path / "direct").glob("*/.*")) and (tmp_path / "direct" / "_SUCCESS").exists()
    assert rows(files.read_entity_text(spark, str(tmp_path / "direct")))
    with pytest.raises(Exception, match="PATH_ALREADY_EXISTS"):
        files.write_entity_text(df, str(tmp_path / "direct"))


def test_index_files_are_those_of_sparks_writer(spark, tmp_path, monkeypatch):
    cells = ["1:00", "", " x ", 'a"b', "t\tt", "n\nn", "nan", None, "é,", "\\", "#"]
    index = [(f"e{i % 3}", i, None if i == 4 else i / 3, c, None if i % 2 else 0.5, c) for i, c in enumerate(cells)]
    df = spark.createDataFrame(
        [*index, *index[:2]], "entity_id string, seq int, hour double, time string, quality double, record_id string"
    )
    with monkeypatch.context() as patch:
        patch.setattr(files, "_local_path", lambda spark, root: None)
        files.write_recording_index(df, str(tmp_path / "by_spark"))
    with monkeypatch.context() as patch:
        patch.setattr(type(df.write), "csv", lambda *_, **__: pytest.fail("one process per entity"))
        files.write_recording_index(df, f"file://{tmp_path}/direct")
    held = [{f.parent.name: f.read_bytes() for f in (tmp_path / n).glob("*/*.tsv")} for n in ("by_spark", "direct")]
    assert held[0] == held[1] and len(held[0]) == 3


@pytest.fixture()
def odd_layout(tmp_path):
    """Folders at any depth, hidden names, links, and files without bytes."""
    root = tmp_path / "odd"
    named = [
        "a/x.txt", "a/deep/deeper/y.txt", "a/_deep/y.txt", "a/.deep/y.txt", "a/_d=1/y.txt", "a/_metadata_d/y.txt",
        "a/_skip.txt", "a/.skip.txt", "a/_metadata.txt", "a/_k=v.txt", "a/z.txt._COPYING_", "a/.txt", "a/h.hea",
        "b._COPYING_/t.txt", "_u/t.txt", "_u/_in/t.txt", "_u/.in/t.txt", "_u/.t.txt", "_u/in/_d/t.txt", "_u/c._COPYING_/t.txt",
        ".v/t.txt", "_m=1/t.txt", "_metadata_x/t.txt", "_common_metadata/t.txt", "entity_id=p%2Fq%25/t.txt", "entity_id=_r/t.txt",
        "100%/t.txt", "p+q/t+u%20.txt", "a b/t.txt", "\u00e9/t.txt", "only.hea/only.hea", "top.txt", "_top.txt", "_SUCCESS",
    ]
    for i, name in enumerate(named):
        (root / name).parent.mkdir(parents=True, exist_ok=True)
        (root / name).write_bytes([b"Age: 1", b"\n\n", b"a\xff\xe2\x82 b\r\n", b"\xc3\xa9\x00\n\r"][i % 4])
    for name in ("no bytes/t.txt", "a/empty.txt"):
        (root / name).parent.mkdir(exist_ok=True)
        (root / name).touch()
    (root / "no files").mkdir()
    (root / "linked").symlink_to(root / "a")
    (root / "a" / "nowhere.txt").symlink_to(root / "gone")
    return str(root)


def by_spark(monkeypatch, read):
    with monkeypatch.context() as patch:
        patch.setattr(files, "_local_path", lambda spark, root: None)
        return rows(read())


def by_tasks(spark, monkeypatch, read):
    with monkeypatch.context() as patch:
        # Spark's readers hold every file in the driver.
        patch.setattr(type(spark.read), "load", lambda *_, **__: pytest.fail("listed by the driver"))
        return rows(read())


@pytest.mark.parametrize("bounds", [(10_000, 4 << 20), (2, 4 << 20), (10_000, 7)])
def test_mounted_folders_are_listed_by_tasks(spark, odd_layout, monkeypatch, bounds):
    wanted = by_spark(monkeypatch, lambda: files.list_entities(spark, odd_layout))
    assert {("deeper",), ("_in",), ("p/q%",), ("100%",), ("odd",), ("linked",), ("only.hea",)} <= set(wanted)
    assert not {("_deep",), ("_d",), ("no bytes",), ("no files",)} & set(wanted)
    for name, bound in zip(("_NAMES", "_HELD_BYTES"), bounds):
        monkeypatch.setattr(files, name, bound, raising=False)
    assert by_tasks(spark, monkeypatch, lambda: files.list_entities(spark, f"file://{odd_layout}/")) == wanted


def test_patterns_and_missing_roots_are_left_to_spark(spark, tmp_path, monkeypatch):
    for name in ("c1/a/t.txt", "c2/b/t.txt", "d/c/t.txt"):
        (tmp_path / name).parent.mkdir(parents=True)
        (tmp_path / name).write_text("Age: 1")
    assert rows(files.list_entities(spark, f"{tmp_path}/c*")) == [("a",), ("b",)]
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        files.list_entities(spark, f"{tmp_path}/e")
    (tmp_path / "e").mkdir()
    assert files.list_entities(spark, f"{tmp_path}/e").collect() == []


@pytest.mark.parametrize("bounds", [(10_000, 4 << 20), (2, 4 << 20), (10_000, 7)])
def test_mounted_files_are_read_by_tasks(spark, odd_layout, monkeypatch, bounds):
    readers = (files.read_entity_text, files.read_record_headers)
    wanted = [by_spark(monkeypatch, lambda: read(spark, odd_layout)) for read in readers]
    assert [len(found) for found in wanted] == [25, 3]
    for name, bound in zip(("_NAMES", "_HELD_BYTES"), bounds):
        monkeypatch.setattr(files, name, bound, raising=False)
    assert [by_tasks(spark, monkeypatch, lambda: read(spark, odd_layout)) for read in readers] == wanted


def test_cells_are_found_once(spark):
    index = spark.createDataFrame([("e", "Record\tHour\n r1 \t1\n")], "entity_id string, text string")
    typed = files.recording_columns(index)
    assert rows(typed) == [("e", 0, 1.0, None, None, "r1")]
    optimized = typed._jdf.queryExecution().optimizedPlan().toString()
    assert optimized.count("array_position(") == len(files.INDEX_COLUMNS)


def test_index_files_are_read_by_tasks(spark, tmp_path, monkeypatch):
    index = spark.createDataFrame(
        [(f"e{i % 5}", i, None if i % 7 == 4 else i / 3, ["1:00", " ", None, "a\tb"][i % 4], 0.5, f"r{i}") for i in range(60)],
        "entity_id string, seq int, hour double, time string, quality double, record_id string",
    )
    root = str(tmp_path / "index")
    files.write_recording_index(index, root)
    wanted = by_spark(monkeypatch, lambda: files.read_recording_index(spark, root))
    assert len(wanted) == 60
    assert by_tasks(spark, monkeypatch, lambda: files.read_recording_index(spark, root)) == wanted

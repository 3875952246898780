"""Array files cut at byte splits, against the whole-file reader; damaged files."""

import json
import random

import pytest
from pyspark.sql import functions as F

from starloom.sources import json_arrays as J
from starloom.sources.zones import quarantined, read_raw

COLUMNS = ["id", "t", "n", "p", "l"]
TEXTS = ["plain", "},{", 'say "hi" {', "\\", '"}]}', "a\nb}", "ü}é{", '{"x":1},{"y":2}', ":", '":"', '\\"},{\\"', "", "{" * 5, "}]"]


def records(n, seed=1):
    rng = random.Random(seed)
    out = []
    for i in range(n):
        r = {"id": str(i), "t": rng.choice(TEXTS), "n": rng.choice([1, 2.5, None, True])}
        if rng.random() < 0.5:
            r["p"] = {"type": "Point", "c": [1, {"z": "}"}]}
        if rng.random() < 0.3:
            r["l"] = [{"a": 1}, {"b": 2}, {"c": "},{"}]
        out.append(r)
    return out


STYLES = {"one line": json.dumps, "indented": lambda r: json.dumps(r, indent=2),
          "a record a line": lambda r: "[\n" + "\n,".join(json.dumps(x, ensure_ascii=False) for x in r) + "\n]\n",
          "spaced": lambda r: "﻿ [ " + " , \t".join(json.dumps(x, separators=(" ,  ", " : ")) for x in r) + " ]  \n"}


def plain(value):
    """A value as the reader gives it: nested ones as JSON without spaces."""
    if value is None or isinstance(value, str):
        return value
    return json.dumps(value, separators=(",", ":"), ensure_ascii=False)


def expected(rows):
    return sorted((tuple(plain(r.get(c)) for c in COLUMNS) for r in rows), key=str)


@pytest.fixture()
def split_bytes(spark):
    """Byte splits of a given size."""
    name = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(name)
    yield lambda n: spark.conf.set(name, n)
    spark.conf.set(name, before)


@pytest.mark.parametrize("style", STYLES)
def test_split_arrays_equal_their_records(spark, tmp_path, split_bytes, style):
    rows = records(1500)
    path = tmp_path / "a.json"
    path.write_text(STYLES[style](rows), encoding="utf-8")
    for size, at_least in ((2500, 20), (1 << 27, 1)):
        split_bytes(size)
        assert spark.read.option("lineSep", "}").text(str(path)).rdd.getNumPartitions() >= at_least
        got = J.read_json_arrays(spark, str(path), COLUMNS).collect()
        assert all(r[J.CORRUPT] is None and r[J.SOURCE].endswith("a.json") for r in got)
        assert sorted((tuple(r[c] for c in COLUMNS) for r in got), key=str) == expected(rows)


def test_equal_to_the_whole_file_reader(spark, tmp_path, split_bytes):
    rows = [{k: v for k, v in r.items() if k in ("id", "t", "n")} for r in records(800, 2)]
    for i in range(3):
        (tmp_path / f"{i}.json").write_text(json.dumps(rows[i::3]))
    split_bytes(3000)
    got = read_raw(spark, str(tmp_path), ["id", "t", "n", "missing"])
    want = spark.read.schema("id string, t string, n string, missing string").option("multiLine", True).json(str(tmp_path))
    assert got.columns == want.columns and got.exceptAll(want).count() == want.exceptAll(got).count() == 0
    assert got.count() == 800


def test_damage_keeps_the_records_before_it(spark, tmp_path, split_bytes):
    rows = [{"id": str(i), "t": "}{ x", "p": {"q": 1}} for i in range(200)]
    whole = json.dumps(rows)
    at = whole.index('"id": "120"')
    cases = {
        "cut in a record": (whole[:at + 9], list(range(120)), ['{"id": "12']),
        "cut in a string": (whole[:at + 22], list(range(120)), [whole[at - 1:at + 22]]),
        "cut after a record": (whole[:at - 3], list(range(120)), [""]),
        "cut before the bracket": (whole[:-1], list(range(200)), [""]),
        "cut after a comma": (whole[:at - 1], list(range(120)), [", "]),
        "a bad record": (whole.replace('"id": "120", ', '"id" "120", '), [i for i in range(200) if i != 120],
                         [', {"id" "120", "t": "}{ x", "p": {"q": 1}}']),
        "text between records": (whole.replace(', {"id": "120"', ', nonsense {"id": "120"'), [i for i in range(200) if i != 120],
                                 [', nonsense {"id": "120", "t": "}{ x", "p": {"q": 1}}']),
        "an empty array": (" [ ] ", [], []), "nothing": ("", [], []), "spaces": (" \n", [], []),
        "one object": ('{"id": "7"}', [7], []), "no array": ('{"id": "7"}\n{"id": "8"}\n', [7, 8], []), "not JSON": ("oops", [], ["oops"]),
    }
    for i, (text, _, _) in enumerate(cases.values()):
        (tmp_path / f"{i}.json").write_text(text)
    for size in (700, 1 << 27):
        split_bytes(size)
        got = J.read_json_arrays(spark, str(tmp_path), COLUMNS).collect()
        for i, (name, (_, ids, lost)) in enumerate(cases.items()):
            mine = [r for r in got if r[J.SOURCE].endswith(f"/{i}.json")]
            assert sorted(int(r.id) for r in mine if r[J.CORRUPT] is None) == ids, name
            assert sorted(r[J.CORRUPT].strip(" ,") for r in mine if r[J.CORRUPT] is not None) == sorted(x.strip(" ,") for x in lost), name


def test_an_open_quote_keeps_the_rest_in_bounded_pieces(spark, tmp_path, split_bytes, monkeypatch):
    monkeypatch.setattr(J, "MAX_RECORD", 1000)
    rows = [{"id": str(i), "t": "word " * 5} for i in range(400)]
    whole = json.dumps(rows)
    at = whole.index('"id": "100"')
    path = tmp_path / "open.json"
    path.write_text(whole[:at + 10] + whole[at + 11:])            # a closing quote is lost
    for size in (2000, 1 << 27):
        split_bytes(size)
        got = J.read_json_arrays(spark, str(path), COLUMNS).collect()
        lost = [r[J.CORRUPT] for r in got if r[J.CORRUPT] is not None]
        assert sorted(int(r.id) for r in got if r[J.CORRUPT] is None) == list(range(100)) and len(lost) > 10 and max(map(len, lost)) < 1200
        assert sum(len(x) for x in lost) >= len(whole) - at - 20      # nothing is dropped


def test_lines_and_arrays_tell_damage_with_its_file(spark, tmp_path):
    (tmp_path / "lines").mkdir()
    (tmp_path / "lines" / "l.json").write_text('{"id": "1", "p": {"q": 1}}\n\n{"id": "2", "t"\n[{"id": "3"}, {"id": "4"}]\n')
    raw = read_raw(spark, str(tmp_path / "lines"), COLUMNS, multi_line=False, damaged=True)
    assert [(r.source_file.rsplit("/", 1)[1], r.record_text) for r in quarantined(raw).collect()] == [("l.json", '{"id": "2", "t"')]
    assert read_raw(spark, str(tmp_path / "lines"), COLUMNS, multi_line=False).count() == 3


def test_load_quarantines_what_it_cannot_read(spark, tmp_path, scratch):
    from conftest import SF001
    from starloom.operators.clean import RAW_COLUMNS, load_audit
    from starloom.plans.full_load import run_full_load
    from starloom.plans.incremental import run_incremental
    from starloom.sources.adapter import raw_incidents
    from starloom.sources.zones import as_raw_strings
    rows = [json.loads(r.j) for r in as_raw_strings(raw_incidents(spark, SF001)).limit(1200)
            .select(F.to_json(F.struct("*")).alias("j")).collect()]
    columns = RAW_COLUMNS + ["created_at", "updated_at"]
    (tmp_path / "a.json").write_text(json.dumps(rows[:1000]))
    text = json.dumps(rows[1000:])
    (tmp_path / "b.json").write_text(text[:-40])                 # truncated in its last record
    raw = read_raw(spark, str(tmp_path), columns, damaged=True)
    audit = {r.outcome: r.n_rows for r in load_audit(raw).collect()}
    assert audit["corrupt"] == 1 and sum(audit.values()) == 1200
    zones = run_full_load(spark, raw, scratch("q"), from_date="1990-01-01")
    stored = {r.outcome: r.n_rows for r in spark.read.parquet(f"{zones.root}/audit").collect()}
    assert {k: v for k, v in stored.items() if v} == audit
    lost = spark.read.parquet(f"{zones.root}/quarantine").collect()
    assert len(lost) == 1 and lost[0].source_file.endswith("b.json") and text[:-40].endswith(lost[0].record_text.lstrip(", "))
    assert lost[0].load_id == "full"
    run_incremental(spark, raw.filter("incident_id is null"), zones.root, as_of="2001-01-01", load_id="b2", since="1995-01-01")
    assert spark.read.parquet(f"{zones.root}/quarantine").filter("load_id = 'b2'").count() == 1

"""Array files read by several tasks equal the plain reader's rows."""

import json
import random

import pytest

from pricelens import schemas as S
from pricelens.sources import json_arrays as JA


@pytest.fixture()
def small_splits(spark):
    names = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    before = {n: spark.conf.get(n) for n in names}
    for n in names:
        spark.conf.set(n, "3000")
    yield
    for n, v in before.items():
        spark.conf.set(n, v)


def records(n, seed=1):
    rnd = random.Random(seed)
    texts = ["plain", 'a "quote" } {', "}}}{{{", "back\\slash\\\\", "line\nend", "é日本", "", "]},{[", '\\"', "long } text " * 300]
    return [{"product_name": rnd.choice(texts), "price": i / 4, "source": "ebay", "sku": str(i), "url": None,
             "raw_payload": rnd.choice([None, {}, {"a": {"b": [{"c": "}"}, {"d": "{"}]}}, {"x": "\\"}])} for i in range(n)]


def rows(df):
    """Rows with the payload as a value: its text may have other blanks."""
    return sorted(str((*r[:-1], r.raw_payload and json.dumps(json.loads(r.raw_payload)))) for r in df.collect())


@pytest.mark.parametrize("indent", [None, 2])
def test_split_reader_equals_the_plain_reader(spark, tmp_path, small_splits, indent):
    for k, n in enumerate((300, 1, 0)):
        (tmp_path / f"f{k}.json").write_text(json.dumps(records(n, k), indent=indent, ensure_ascii=bool(k)))
    (tmp_path / "f9.json").write_text("")
    paths = [str(tmp_path / f"f{k}.json") for k in (0, 1, 2)]
    got = JA.read_json_arrays(spark, [*paths, str(tmp_path / "f9.json")], S.LISTING_JSON)
    assert rows(got) == rows(spark.read.schema(S.LISTING_JSON).option("multiLine", True).json(paths)) and got.count() == 301
    assert spark.read.option("lineSep", "}").text(paths).rdd.getNumPartitions() > 20


def test_objects_larger_than_many_splits(spark, tmp_path, small_splits):
    data = [{"sku": "a"}, {"sku": "b", "product_name": "} x {" * 5000}, {"sku": "c", "raw_payload": {"k": ["{"] * 4000}}, {"sku": "d"}]
    path = tmp_path / "f.json"
    path.write_text(json.dumps(data))
    got = JA.read_json_arrays(spark, [str(path)], S.LISTING_JSON)
    assert rows(got) == rows(spark.read.schema(S.LISTING_JSON).option("multiLine", True).json(str(path)))


def test_walk_follows_strings():
    assert JA.walk('{"a": {"b": "x', False) == (True, 2)
    assert JA.walk('y\\" z", "c": {', True) == (False, 1)
    assert JA.walk("no end { {", True) == (True, 0)
    assert JA.walk(', {"q": "\\\\", "r": "{"', False) == (False, 1)


def test_large_listing_files_take_the_split_reader(spark, tmp_path, small_splits, monkeypatch):
    from pricelens.sources import listings as IO

    path = tmp_path / "big.json"
    path.write_text(json.dumps(records(200)))
    used = []
    real = JA.read_json_arrays
    monkeypatch.setattr(IO, "read_json_arrays", lambda *a: (used.append(a), real(*a))[1])
    got = rows(IO.read_listing_json(spark, [str(path)]))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "128m")
    assert rows(IO.read_listing_json(spark, [str(path)])) == got and len(used) == 1


def test_scan_of_many_pieces_equals_the_walk_and_the_cutter():
    """Pieces are looked at together; odd ones (marks out of place) must give what one by one gives."""
    import numpy as np
    import pyarrow as pa

    rnd = random.Random(3)
    good = '"a\\"b"', ',{"k":1', '{"x":"\\\\"', '"', "{", "]", ",", " ", '"q {"', "é", ""
    for case in range(300):
        bits = [*good, *["\\", '\\"', "\\\\"] * (case % 3)]
        pieces = ["".join(rnd.choice(bits) for _ in range(rnd.randrange(6))) if case % 2 else rnd.choice(good[:4]) for _ in range(rnd.randrange(1, 30))]
        values = pa.array(["skipped", *pieces]).slice(1)
        for begin in (False, True):
            before, end, opened = JA._Scan(values).run(begin)
            state = begin
            for i, piece in enumerate(pieces):
                assert before[i] == state
                state, n = JA.walk(piece, state)
                assert (end[i], opened[i]) == (state, n)
            for depth in (0, 1, 2):
                one, many = JA._Cutter("p", 5, begin, depth, 2), JA._Cutter("p", 5, begin, depth, 2)
                want = [r for r in map(one.take, pieces) if r] + [r for r in [one.finish()] if r]
                cut = rnd.randrange(len(pieces) + 1)
                got = [x for part in (values.slice(0, cut), values.slice(cut)) for r in many.take_all(part)
                       for x in ([("p", 5, 5, t, True) for t in r.to_pylist()] if isinstance(r, pa.Array) else [r])]
                assert got + [r for r in [many.finish()] if r] == want
    assert np.array_equal(JA._Scan(pa.array(['{"a": 1', ',{"b": 2'])).run(False)[2], [1, 1])

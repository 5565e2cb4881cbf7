"""CSV and JSON arrays cut over many splits, against Python's own readers of whole files."""

import csv
import io
import json
import random

import pytest
from pyspark.sql import functions as F

from loomtable.operators import split
from loomtable.sources import cut, files, sinks


@pytest.fixture(params=[600, 1 << 20])
def small_splits(spark, request):
    old = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(request.param))
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    yield request.param
    for k, v in old.items():
        spark.conf.set(k, v)


def table(rng, n):
    cell = lambda: rng.choice(["", "a", "b c", 'say "hi"', "two\nlines", "x,y", "\n\n", '"', 'é"\n,"', "long " * 30 + "\n" + "tail " * 20, "cr\r\nlf"])
    return [["name", "img", "colour"]] + [[cell() for _ in range(rng.choice([3, 3, 3, 2, 4, 6]))] for _ in range(n)]


def test_csv_over_splits(spark, tmp_path, small_splits):
    rng = random.Random(small_splits)
    for k in range(3):
        with open(tmp_path / f"{k}.csv", "w", newline="", encoding="utf-8") as f:
            csv.writer(f, lineterminator=["\n", "\r\n"][k % 2]).writerows(table(rng, 30))
    want = []
    for k in range(3):
        with open(tmp_path / f"{k}.csv", newline="", encoding="utf-8") as f:
            want += list(csv.DictReader(f, restkey="over"))
    rows = files.read_csv(spark, str(tmp_path), overflow="over", seq="seq")
    got = [r.asDict() for r in sorted(rows.collect(), key=lambda r: r.seq)]
    assert [{k: v for k, v in r.items() if k != "seq"} for r in got] == [{**w, "over": w.get("over")} for w in want]
    assert len({r["seq"] for r in got}) == len(got)
    splits = cut._transitions(cut._pieces(spark, str(tmp_path), cut.Csv), cut.Csv).count()
    assert splits > 10 if small_splits < 1000 else splits >= 3


ODD_CSV = ['a,b\n1,2', 'a,b\n1,"open quote\nto the end', 'a,b\n1,x"y"z\n"q"uote,"a""b"\n', 'a,b\n\n\n1,2\n\n', 'a,b\r\n"1\r\n2",3\r\n', 'a,a,b\n1,2,3\n', 'a,b\n""\n"",""\n', 'a,b\n"x" ,y\n"x"z"\nw",y\n']


@pytest.fixture
def dealt(monkeypatch):
    """Pieces as a file's splits would give them, a few pieces a split, without a file of a block's size."""

    def pieces(spark, path, kind):
        text = open(path, newline="", encoding="utf-8").read()
        values = text.split(kind.sep)
        values = values[:-1] if text.endswith(kind.sep) else values
        rows = [(f"file:{path}", i // every, v) for i, v in enumerate(values)]
        splits = spark.sparkContext.parallelize([rows[i:i + every] for i in range(0, len(rows), every)], 4)
        return splits.flatMap(lambda x: x).toDF("file string, start long, value string")

    every = 1
    monkeypatch.setattr(cut, "_pieces", pieces)

    def use(n):
        nonlocal every
        every = n

    return use


def test_odd_csv(spark, tmp_path, dealt):
    dealt(1)
    for k, text in enumerate(ODD_CSV):
        (tmp_path / f"{k}.csv").write_bytes(text.encode())
        got = sorted(files.read_csv(spark, str(tmp_path / f"{k}.csv"), seq="seq").collect(), key=lambda r: r.seq)
        want = [{n: v for n, v in r.items() if n is not None} for r in csv.DictReader(io.StringIO(text, newline=""))]
        assert [{n: r[n] for n in r.asDict() if n != "seq"} for r in got] == want, text


def test_json_pieces_as_splits(spark, tmp_path, dealt):
    rng = random.Random(2)
    for every, n in ((1, 9), (2, 12), (7, 30)):
        dealt(every)
        made = objects(rng, n)
        (tmp_path / "a.json").write_text(json.dumps(made, indent=1))
        found = sorted(cut.json_elements(spark, str(tmp_path / "a.json")).collect(), key=lambda r: r.seq)
        assert [json.loads(r.text) for r in found] == made


def objects(rng, n):
    value = lambda: rng.choice(["", "a", '"}{"', "\\", 'back\\"slash}', "line\nend", "[{]", "é ", "x" * 90, "}"])
    return [{"title": value(), "deep": {"a": [{"b": value()}, value()], "c": {}}, "n": i} for i in range(n)]


def test_json_array_over_splits(spark, tmp_path, small_splits):
    rng = random.Random(small_splits)
    made = [objects(rng, n) for n in (25, 1, 0, 15)]
    for k, x in enumerate(made):
        (tmp_path / f"{k}.json").write_text(json.dumps(x, indent=k % 2 or None, ensure_ascii=bool(k)), encoding="utf-8")
    found = sorted(cut.json_elements(spark, str(tmp_path)).collect(), key=lambda r: r.seq)
    assert [json.loads(r.text) for r in found] == [o for x in made for o in x]
    if small_splits == 600:
        assert cut._transitions(cut._pieces(spark, str(tmp_path), cut.Json), cut.Json).count() > 10


@pytest.mark.parametrize("text", ['[{"a": 1}', '[{"a": 1}] x', '[1, {"a": 1}]', '[{"a": 1} {"a": 2}]', '[{"a": 1}][{"a": 2}]', '{"a": 1}', '["}"]', '[{"a": 1}, 5]'])
def test_what_is_no_array_is_malformed(spark, tmp_path, text):
    (tmp_path / "x.json").write_text(text)
    with pytest.raises(cut.Malformed):
        cut.json_elements(spark, str(tmp_path / "x.json"))


def test_arrays_are_written_by_tasks(spark, tmp_path):
    rows = spark.range(100).select(F.col("id").alias("n"), F.when(F.col("id") % 3 == 0, F.concat(F.lit('q"}\n'), F.col("id").cast("string"))).alias("title"))
    sinks.write_json_arrays(rows.repartition(5), str(tmp_path / "a"))
    sinks.write_json_arrays(rows.limit(0), str(tmp_path / "none"))
    back = files.read_array(spark, str(tmp_path / "a"), rows.schema)
    assert sorted(map(tuple, back.collect()), key=repr) == sorted(map(tuple, rows.collect()), key=repr)
    assert files.read_array(spark, str(tmp_path / "none"), rows.schema).count() == 0
    for part in (tmp_path / "a").glob("part-*"):
        assert isinstance(json.loads(part.read_text()), list)


def test_places_are_a_permutation_at_size(spark):
    """Two million rows with wide columns, written: ranges are sampled, and every row must keep one place."""
    n = 2_000_000
    rows = spark.range(n).select(F.xxhash64("id").alias("seq"), "id", F.sha2(F.col("id").cast("string"), 256).alias("wide"), F.repeat(F.md5(F.col("id").cast("string")), 3).alias("wider"))
    got = split.in_order(rows, "seq").agg(F.count("*").alias("n"), F.count_distinct("place").alias("places"), F.min("place").alias("low"), F.max("place").alias("high"), F.count_distinct("id").alias("ids")).first()
    assert tuple(got) == (n, n, 0, n - 1, n)


def test_requests_go_round_at_size(spark):
    rows = spark.range(300_000).select(F.xxhash64("id").alias("seq"), F.md5(F.col("id").cast("string")).alias("wide"))
    got = split.cycled(rows, "seq", 300_007, 5).agg(F.count("*").alias("n"), F.count_distinct("i").alias("i"), F.count_distinct("seq").alias("rows")).first()
    assert tuple(got) == (300_007, 300_007, 300_000)

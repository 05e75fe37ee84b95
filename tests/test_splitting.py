"""Files whose records span lines: many splits of one file against Spark's one-task readers."""

import json
import random

import pytest
from pyspark.sql import functions as F

from assayframe.sources import readers, splitting


@pytest.fixture
def split_size(spark):
    names = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    before = [spark.conf.get(n) for n in names]

    def set_to(size):
        spark.conf.set(names[0], size)
        spark.conf.set(names[1], "1")

    yield set_to
    for n, v in zip(names, before):
        spark.conf.set(n, v)


def rows(df):
    return sorted(map(str, df.collect()))


def _value(rnd, end, stray):
    kind = rnd.random()
    letters = ["a", "é", "b c", ",", '"', end, "'", "\\"] if kind < .5 else ["a", "b", "é", "x"]
    text = "".join(rnd.choice(letters) for _ in range(rnd.randrange(0, 12)))
    if kind < .5:
        return '"' + text.replace('"', '""') + '"'
    return text + rnd.choice(['"', '" x', '"y"']) if stray and kind < .6 else text


@pytest.mark.parametrize("seed,end", [(1, "\n"), (2, "\n"), (3, "\r\n")])
def test_csv_records_equal_multi_line_reader(spark, tmp_path, split_size, seed, end):
    rnd = random.Random(seed)
    for f in range(2):
        lines = [",".join(_value(rnd, end, end == "\n") for _ in range(rnd.choice([3, 3, 2, 4])))
                 for _ in range(rnd.randrange(1, 60))]
        (tmp_path / f"{f}.csv").write_bytes(
            end.join(["a,b,c", "", *lines, ""]).encode())
    want = rows(spark.read.options(header=True, nullValue="", escape='"', multiLine=True)
                .csv(str(tmp_path)))
    for size in ("32", "100", "10m"):
        split_size(size)
        found = splitting.csv_records(spark, str(tmp_path)).where("NOT first").select(F.from_csv(
            "record", "a string, b string, c string", {"nullValue": "", "escape": '"'}).alias("r"))
        assert rows(found.select("r.*")) == want, size


def test_one_csv_file_is_read_by_many_tasks(spark, tmp_path, split_size):
    long = "\n".join(f"line {i}, ""of"" a value" for i in range(40))
    body = "".join(f'{i},"{long}",{i}\n' if i % 7 == 0 else f"{i},plain,{i}\n" for i in range(200))
    (tmp_path / "one.csv").write_text("age,department,record_id\n" + body)
    split_size("300")
    df = readers.read_csv_typed(spark, str(tmp_path / "one.csv"))
    assert df.rdd.getNumPartitions() > 10
    got = {r["record_id"]: (r["age"], r["department"]) for r in df.collect()}
    assert got == {i: (i, long if i % 7 == 0 else "plain") for i in range(200)}
    split_size("10m")
    assert rows(df) == rows(readers.read_csv_typed(spark, str(tmp_path / "one.csv")))


def test_csv_open_quote_and_header_alone(spark, tmp_path, split_size):
    (tmp_path / "a.csv").write_text("a,b\n")
    (tmp_path / "b.csv").write_text('a,b\n1,"never\nclosed,\n2,3\n')
    want = rows(spark.read.options(header=True, nullValue="", escape='"', multiLine=True)
                .csv(str(tmp_path)))
    for size in ("4", "10m"):
        split_size(size)
        found = splitting.csv_records(spark, str(tmp_path)).where("NOT first")
        assert found.count() == len(want) == 1


@pytest.mark.parametrize("seed", [1, 2])
def test_json_arrays_equal_multi_line_reader(spark, tmp_path, split_size, seed):
    rnd = random.Random(seed)

    def item():
        text = "".join(rnd.choice('a"}{\\]é\n') for _ in range(rnd.randrange(8)))
        return {"id": rnd.randrange(99), "t": text,
                "n": [{"k": "}" * rnd.randrange(3)} for _ in range(rnd.randrange(3))]}

    for f, indent in enumerate([None, 1, 2]):
        items = [item() for _ in range(rnd.randrange(40) if f else 0)]
        (tmp_path / f"{f}.json").write_text(json.dumps(items, indent=indent, ensure_ascii=f == 1))
    schema = "id bigint, t string, n array<struct<k:string>>"
    want = rows(readers.read_json_array(spark, str(tmp_path), schema, split=False))
    for size in ("16", "100", "10m"):
        split_size(size)
        assert rows(readers.read_json_array(spark, str(tmp_path), schema)) == want, size


def test_moves_by_brute_force():
    """What a line does to a quote, against a walk over its characters."""
    machine = splitting.Csv()

    def walk(line, quoted):
        state, i = ("quoted" if quoted else "start"), 0
        while i < len(line):
            c = line[i]
            if state == "quoted":
                if c == '"' and line[i + 1:i + 2] == '"':
                    i += 1
                elif c == '"':
                    state = "plain"
            elif c == ",":
                state = "start"
            else:
                state = "quoted" if c == '"' and state == "start" else "plain"
            i += 1
        return int(state == "quoted")

    rnd = random.Random(5)
    for _ in range(3000):
        line = "".join(rnd.choice('a",') for _ in range(rnd.randrange(9)))
        assert machine.moves(line) == ((walk(line, False), 0), (walk(line, True), 0)), line

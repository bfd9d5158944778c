"""Records cut from byte ranges against the reader that takes a file whole."""

import random

import pytest
from signpost.sources import delimited as D
from signpost.sources.records import inside_after, records


@pytest.fixture
def small_ranges(spark):
    """A session whose files are read in ranges of so many bytes."""
    names = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    before = [spark.conf.get(n) for n in names]

    def set_to(size):
        for n, v in zip(names, (size, 1)):
            spark.conf.set(n, str(v))

    yield set_to
    for n, v in zip(names, before):
        spark.conf.set(n, v)


FIELDS = [
    "plain", "", '""', '"quoted"', '"a,b"', '"two\nlines"', '"two\r\nlines"', '"""said"" he"', 'bare"quote', 'x"y"z', '"end" ',
    '"many\n\n\nlines, and ""quotes""\n"', " led", "tr ", "é 字", '"' + "long line\n" * 60 + '"', '"a"b"', "a'b",
]


def written(folder, seed, rows):
    pick = random.Random(seed)
    for name in ("b.csv", "a.CSV", "c.csv"):
        parts = ["mid,job_intro\n"]
        for k in range(rows):
            fields = [f"{name}{k}" if pick.random() < 0.9 else pick.choice(FIELDS)]
            fields += [pick.choice(FIELDS) for _ in range(pick.choice([0, 1, 1, 1, 2]))]
            parts.append(",".join(fields) + pick.choice(["\n", "\n", "\r\n", "\n\n"]))
        (folder / name).write_text("".join(parts), newline="")


def rows_of(frame):
    return [tuple(r) for r in frame.orderBy("ordinal").select("mid", "job_intro", "path").collect()]


@pytest.mark.parametrize("size", [37, 300, 1 << 20])
def test_same_rows_as_the_whole_reader(spark, small_ranges, tmp_path, size):
    written(tmp_path, size, 120)
    small_ranges(1 << 27)
    raw = D._load(spark, str(tmp_path), D.POSTING_SCHEMA)
    want = rows_of(D.parse_postings(D._in_file_order(raw, raw.inputFiles())))
    small_ranges(size)
    got = rows_of(D.read_postings(spark, str(tmp_path)))
    assert len(got) == len(want) > 250
    for g, w in zip(got, want):
        assert g == w
    if size < 1 << 20:
        assert records(spark, str(tmp_path)).rdd.getNumPartitions() > 20


def test_numbers_and_an_open_quote(spark, small_ranges, tmp_path):
    (tmp_path / "x.csv").write_text('h,t\n\na,"1\n2"\n\nb,2\nc,"never closed\nto the end\n' + "more\n" * 50)
    small_ranges(16)
    got = {r.row: r.record for r in records(spark, str(tmp_path / "x.csv")).collect()}
    assert set(got) == {0, 1, 2, 3} and got[1] == 'a,"1\n2"' and got[2] == "b,2"
    assert got[3] == ('c,"never closed\nto the end\n' + "more\n" * 50).rstrip("\n")


def test_empty_files(spark, tmp_path):
    (tmp_path / "e.csv").write_text("")
    (tmp_path / "h.csv").write_text("mid,job_intro")
    assert D.read_postings(spark, str(tmp_path)).count() == 0


@pytest.mark.parametrize(
    "line, outside, inside",
    [
        ("plain", False, True), ('"open', True, True), ('a,"open', True, True), ('a"b', False, True), ('x" ,y', False, False),
        ('""', False, True), ('"a""b"', False, False), ('"a" \r', False, False), ('","', False, True), ('a,"b","c', True, True),
    ],
)
def test_state_after_a_line(line, outside, inside):
    assert (inside_after(line, False), inside_after(line, True)) == (outside, inside)

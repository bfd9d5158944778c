import json
import os

from signpost.operators.routing import initial_status
from signpost.operators.store import import_stats
from signpost.sources import delimited as D
from signpost.sources import sinks as W
from signpost.sources.manifest import read_manifests
from signpost.sources.taxonomy import read_taxonomy

MESSY = (
    "whatever,header,is,ignored\n"
    'a1,"line1\nline2, ""q"""\r\n'
    "onlyone\n"
    "\n"
    " ,blank mid\n"
    "a2,short\r\n"
    "a3,\n"
    'a5,""\n'
    '　a4　,ab"c def,extra\n'
    "a6,六个字的描述\n"
    'a7,"quoted\r\nbreak"\r\n'
    '"a,8"\n'
    'a9,"say "hi" now"\n'
    "a9,last one of a file"
)


def write(path, text):
    path.write_bytes(text.encode())
    return str(path)


def test_messy_postings(spark, tmp_path):
    folder = tmp_path / "board"
    (folder / "sub").mkdir(parents=True)
    write(folder / "one.v1.CSV", MESSY)
    write(folder / "two.csv", "h,h\nb1,a long enough text\n")
    write(folder / "note.txt", "h,h\nx1,not a posting file\n")
    write(folder / "sub" / "three.csv", "h,h\nx2,in a folder below\n")
    rows = D.read_postings(spark, str(folder)).orderBy("base", "ordinal").collect()
    got = [(r.mid, r.job_intro, r.is_filtered) for r in rows]
    assert got == [
        ("a1", 'line1\nline2, "q"', False),
        ("a2", "short", True),
        ("a3", "", True),
        ("a5", "", True),
        ("a4", 'ab"c def', False),
        ("a6", "六个字的描述", False),
        ("a7", "quoted\nbreak", False),
        ("a9", 'say "hi" now', False),
        ("a9", "last one of a file", False),
        ("b1", "a long enough text", False),
    ]
    assert {(r.source, r.base) for r in rows} == {("board", "one.v1"), ("board", "two")}
    stats = import_stats(D.read_postings(spark, str(folder)), "base").orderBy("base").collect()
    assert [tuple(r) for r in stats] == [("one.v1", 9, 6, 3), ("two", 1, 1, 0)]
    one = D.read_postings(spark, str(folder / "two.csv"), tasks=3)
    assert one.count() == 1 and initial_status(one).first().status == "待处理"


def test_row_count_rules(spark, tmp_path):
    write(tmp_path / "clean.csv", 'h,g\na,"x, ""y"""\nb,"two\nlines"\n,no key\n')
    write(tmp_path / "ragged.csv", "h,g\na,b\nc\nd,e,f\n")
    write(tmp_path / "stray.csv", 'h,g\na,b"c\n')
    write(tmp_path / "empty.csv", "h,g\n")
    write(tmp_path / "header.csv", "h,g,i\na,b\nc,d\n")
    write(tmp_path / "quote.csv", 'h,g"x\na,b\n')

    def counts(mode):
        rows = D.csv_row_count(spark, str(tmp_path), mode).collect()
        return {os.path.basename(r.path)[:-4]: r.row_count for r in rows}

    assert counts("any") == {"clean": 3, "ragged": 3, "stray": 1, "header": 2, "quote": 1}
    assert counts("keyed") == {"clean": 2, "ragged": 2, "stray": 1, "header": 2, "quote": 1}
    assert counts("strict") == {"clean": 3}


def test_a_wide_record_leaves_its_neighbours_alone(spark, tmp_path):
    write(tmp_path / "w.csv", "h,h\na,first of them\nb,wide one" + ",x" * 5001 + "\nc,last of them\n")
    rows = D.read_postings(spark, str(tmp_path)).orderBy("ordinal").collect()
    assert [(r.mid, r.job_intro) for r in rows] == [
        ("a", "first of them"), ("b", "wide one"), ("c", "last of them")
    ]


def test_files_come_in_the_order_of_their_paths(spark, tmp_path):
    """Whatever their sizes: the reader takes large files first."""
    write(tmp_path / "a b.csv", "h,h\nk,from the small one\n")
    write(tmp_path / "b.csv", "h,h\nk,from the large one\n" + "x,text that fills\n" * 20_000)
    rows = D.read_postings(spark, str(tmp_path)).filter("mid = 'k'").orderBy("ordinal").collect()
    assert [r.job_intro for r in rows] == ["from the small one", "from the large one"]
    ids = D.read_ids(spark, str(tmp_path), "id string, t string", "id").filter("mid = 'k'")
    assert [r.t for r in ids.orderBy("ordinal").collect()] == ["from the small one", "from the large one"]


def test_taxonomy_file(spark, tmp_path):
    base = {"大类": "**B** ", "细类（职业）": "1-01", "源行号": 7}
    records = [
        {**base, "LLM典型职责": ["a", None, 3, " **b** "], "LLM关联关键词": '["k", "l"]',
         "LLM典型岗位": "t；u", "LLM岗位概述": 5},
        {"大类": "no code"},
        {**base, "细类（职业）": "1-02", "LLM典型职责": None, "LLM典型岗位": "a;"},
    ]
    path = write(tmp_path / "t.json", json.dumps(records, ensure_ascii=False))
    first, second = read_taxonomy(spark, path).orderBy("ordinal").collect()
    assert (first.code, first.big, first.source_row, first.overview) == ("1-01", "B", "", "5")
    assert (first.duties, first.keywords, first.titles) == (["a", "3", "b"], ["k", "l"], ["t", "u"])
    assert (second.code, second.overview, second.duties, second.titles) == ("1-02", "", [], ["a;"])
    kept = read_taxonomy(spark, path, keep_scalars=True).orderBy("ordinal").first()
    assert kept.source_row == "7"


def test_manifests(spark, tmp_path):
    good = "total=3\nprocessed=2\nfiltered=1\ndb=3\nok=True\n"
    cases = {
        "good": good,
        "extra": "x=1=2\n\n" + good,
        "again": good.replace("total=3", "total=9") + "total=3\n",
        "uneven": good.replace("db=3", "db=4"),
        "missing": good.replace("filtered=1\n", ""),
        "no_db": good.replace("db=3\n", ""),
        "no_pair": good + "oops\n",
        "maybe": good.replace("True", "maybe"),
        "decimal": good.replace("db=3", "db=3.0"),
        "signed": good.replace("db=3", "db=+3"),
        "negative": "total=-1\nprocessed=-1\nfiltered=0\ndb=-1\nok=true",
    }
    for name, text in cases.items():
        write(tmp_path / f"{name}.txt", text)

    def valid(**options):
        rows = read_manifests(spark, str(tmp_path), **options).collect()
        return {os.path.basename(r.path)[:-4]: r.is_valid for r in rows}

    readable = {"good": True, "extra": True, "again": True, "uneven": False, "signed": True,
                "negative": False}
    assert valid() == readable
    assert valid(need_db=False) == {**readable, "uneven": True, "no_db": True, "decimal": True}


def test_enriched_file_is_all_or_nothing(spark, tmp_path):
    lists = "duties array<string>, keywords array<string>, titles array<string>"
    rows = spark.createDataFrame([("c", "o", ["a"], [], []), ("d", "p", [], [], [])],
                                 f"code string, overview string, {lists}")
    answers = spark.createDataFrame([("c", None, None, None, None, "bad"), ("d", "new", ["x"], [], [], None)],
                                    f"code string, overview string, {lists}, error string")
    path = str(tmp_path / "out")

    def found():
        read = read_taxonomy(spark, W.enriched_folder(spark, path), lines=True)
        return {r.code: (r.overview, r.duties) for r in read.collect()}

    assert not W.write_enriched_taxonomy(rows, answers, path) and not os.path.exists(path)
    assert W.write_enriched_taxonomy(rows, answers.filter("error is null"), path)
    assert found() == {"c": ("o", ["a"]), "d": ("new", ["x"])}
    assert not W.write_enriched_taxonomy(rows, answers, path)
    assert found()["d"] == ("new", ["x"])

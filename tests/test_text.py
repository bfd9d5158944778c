import random

from pyspark.sql import functions as F

from signpost.functions import payloads as P
from signpost.functions import text as X
from signpost.functions.progress import progress_pct, progress_status
from signpost.schema import WHITE_SPACE


def apply(spark, column, values, kind="string"):
    rows = [(i, v) for i, v in enumerate(values)]
    df = spark.createDataFrame(rows, f"i int, v {kind}").select("i", column.alias("r"))
    return [r["r"] for r in sorted(df.collect())]


def test_trim_takes_every_white_space_and_no_more(spark):
    zero_width = "​"
    got = apply(spark, X.trim_u("v"), [f"{WHITE_SPACE}a b{WHITE_SPACE}", WHITE_SPACE, zero_width])
    assert got == ["a b", "", zero_width]


def test_short_counts_code_points(spark):
    values = ["short", "六个字的描述", " 五个字的述 ", "😀😀😀😀😀", "", None]
    assert apply(spark, X.is_short("v"), values) == [True, False, True, True, True, True]


def test_cells(spark):
    assert apply(spark, X.clean_cell("v"), ["\r\na\r\nb\n\nc\td\r"]) == ["a b  c d"]
    cut = apply(spark, X.truncate_text("v", 3), [" abc ", "abcd", "大类含义"])
    assert cut == ["abc", "abc...", "大类含..."]
    assert apply(spark, X.safe_metadata("v"), [' a"\nb ', None]) == [' a" b ', ""]
    assert apply(spark, X.safe_metadata("v", legacy_quotes=True), ['a"']) == ['a""']


def test_list_field(spark):
    cases = {
        None: [],
        "  ": [],
        '["a"," **b** ",null,""]': ["a", "b"],
        "[]": [],
        "a；b,c\n d ": ["a", "b", "c", "d"],
        "a;": ["a;"],
        "；，": ["；，"],
        '["a", 3]': ['["a"', "3]"],
        '["a"] x ["b"]': ['["a"] x ["b"]'],
        "[x]": ["[x]"],
        "**bold**": ["bold"],
    }
    assert apply(spark, X.parse_list_field("v"), list(cases)) == list(cases.values())


def test_job_id(spark):
    ok = "0123456789abcdefABCDEF0123456789"
    got = apply(spark, X.is_job_id("v"), [ok, ok + "0", ok[:-1], ok[:-1] + "g", ok + "\n"])
    assert got == [True, False, False, False, False]


def test_json_reply_handling(spark):
    values = ['Sure {"a": {"b": 1}} ok', '{"a":1} {"b":2}', "no", "} {", '{"a":1']
    assert apply(spark, P.extract_json("v"), values) == ['{"a": {"b": 1}}', None, None, None, None]
    fenced = ["```json\n{}\n``` bye", " ```JSON {} ", "```\n{}```", "{} ```", "```{}"]
    assert apply(spark, P.strip_code_fence("v"), fenced) == ["{}", "{}", "{}", "{} ```", "{}"]
    assert apply(spark, P.normalize_json("v"), ['{"b": 1, "a": [1 , 2]}', "x"]) == [
        '{"a":[1,2],"b":1}',
        None,
    ]
    assert apply(spark, P.json_or_default("v"), [" [1] ", "", "x", None, "null", "1,2"]) == [
        "[1]", "[]", "[]", "[]", "null", "[]",
    ]


def test_structured_text(spark):
    whole = (
        '{"岗位概述":"s","核心职责":["a",null],"技能标签":[],"行业":"i","工作地点":null,'
        '"可能对应的大类":[{"名称":"n","信心":0.125},{"名称":"","信心":1},{"名称":"m"}],"x":{}}'
    )
    lines = "岗位概述: s\n核心职责: a；\n行业: i\n大类猜测: n(信心0.12)；m(信心0.00)"
    raw = [
        '{"岗位概述":1}',
        '{"核心职责":"a"}',
        '{"核心职责":["a",1]}',
        '{"可能对应的大类":[{"名称":"n","信心":"0.5"}]}',
        '{"可能对应的大类":["n"]}',
        "[]",
        "plain",
        '{"岗位概述":"s"} tail',
    ]
    got = apply(spark, P.format_structured("v"), [whole, "null", "{}", " ", None, *raw])
    assert got == [lines, "", "", "", "", *raw]


def test_two_decimals_round_like_exact_binary(spark):
    values = [i / 1000 for i in range(1001)] + [0.125, 0.375, 1e-9]
    got = apply(spark, P.two_decimals(F.col("v")), values, "double")
    assert got == [f"{v:.2f}" for v in values]


def test_posting_text_without_payload(spark):
    text = P.posting_embedding_text(F.lit(None).cast("string"), "v", F.lit("s"), F.lit("t"), F.lit(None).cast("string"))
    assert apply(spark, text, ["x"]) == ["岗位描述: x\n来源: s\n状态: t\n分类: "]


def test_enrichment_decoding(spark):
    good = '{"LLM岗位概述":"o","LLM典型职责":["d"],"LLM关联关键词":["k"],"LLM典型岗位":["t"]}'
    decoded = P.decode_enrichment("v")
    cases = [f"```json\n{good}\n```", good.replace('"o"', "1"), good.replace('["d"]', '"d"'), "x"]
    got = apply(spark, decoded.isNotNull(), cases)
    assert got == [True, False, False, False]
    missing = P.validate_enrichment(
        decoded["LLM岗位概述"], decoded["LLM典型职责"], decoded["LLM关联关键词"], decoded["LLM典型岗位"]
    )
    cases = [good, good.replace('"o"', '" "'), good.replace('["k"]', "[]"), "{}"]
    assert apply(spark, missing, cases) == [None, "LLM岗位概述", "LLM关联关键词", "LLM岗位概述"]


def test_progress_figures(spark):
    rows = [(0, 5), (10, 10), (10, 11), (1000, 1), (10, -1), (10, 0)]
    df = spark.createDataFrame(rows, "s long, d long").select(progress_pct("s", "d").alias("p"))
    pct = [r["p"] for r in df.collect()]
    assert pct == [0.0, 100.0, 99.9, 0.1, 0.0, 0.0]
    assert apply(spark, progress_status("v"), [100.0, 99.9, 0.0], "double") == [
        "completed", "processing", "pending",
    ]


def test_two_decimals_everywhere(spark):
    """The same rounding rule for every size and sign, against plain formatting."""
    rng = random.Random(4)
    values = [0.0, 0.005, 0.125, 0.375, 0.995, 0.999, 1.0, 1.005, 2.5, 2.675, 99.995, 1e15 + 0.125, 2.0**53, 1e18]
    values += [rng.random() for _ in range(500)] + [rng.uniform(0, 10**k) for k in range(15) for _ in range(50)]
    values += [k / 8 for k in range(400)] + [k / 1000 for k in range(5000)]
    values += [-v for v in values if v]
    rows = spark.createDataFrame([(v,) for v in values], "v double").select("v", P.two_decimals(F.col("v")).alias("t"))
    wrong = [(r.v, r.t) for r in rows.collect() if r.t != f"{r.v:.2f}"]
    assert not wrong, wrong[:10]


def test_two_decimals_beyond_longs(spark):
    """Numbers without decimals, and those that are none, go to Java's formatting."""
    values = [1e300, -1e300, 2.0**63, float("inf"), float("-inf"), float("nan")]
    rows = spark.createDataFrame([(v,) for v in values], "v double").select("v", P.two_decimals(F.col("v")).alias("t"))
    got = [r.t for r in rows.collect()]
    assert got[:2] == ["1" + "0" * 300 + ".00", "-1" + "0" * 300 + ".00"]
    assert got[3:6] == ["Infinity", "-Infinity", "NaN"]
    assert got[2].startswith("922337203685477") and got[2].endswith(".00")

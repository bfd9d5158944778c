"""Fixed names and values of the data model.

Everything in this module is a fixed value: status words, column titles and
JSON field names have to be exactly these for results to be interchangeable.
"""

from pyspark.sql import types as T

# Life cycle of a stored posting.
STATUS_PENDING = "待处理"
STATUS_FILTERED = "过滤"
STATUS_DONE = "处理完成"

# The 12 columns of a result row, in order.
RESULT_COLUMNS = [
    "job_id",
    "job_intro",
    "similarity_score",
    "大类",
    "大类含义",
    "中类",
    "中类含义",
    "小类",
    "小类含义",
    "细类职业",
    "细类含义",
    "细类主要工作任务",
]

# Taxonomy file field -> column of a taxonomy DataFrame.
TAXONOMY_TEXT_FIELDS = {
    "大类": "big",
    "大类含义": "big_meaning",
    "中类": "middle",
    "中类含义": "middle_meaning",
    "小类": "small",
    "小类含义": "small_meaning",
    "细类（职业）": "code",
    "细类含义": "code_meaning",
    "细类主要工作任务": "tasks",
    "细类包含工种": "included_jobs",
    "源行号": "source_row",
}
TAXONOMY_OVERVIEW_FIELD = "LLM岗位概述"
TAXONOMY_LIST_FIELDS = {
    "LLM典型职责": "duties",
    "LLM关联关键词": "keywords",
    "LLM典型岗位": "titles",
}

# Fields of the structured payload of a posting.
PAYLOAD_SUMMARY = "岗位概述"
PAYLOAD_DUTIES = "核心职责"
PAYLOAD_SKILLS = "技能标签"
PAYLOAD_INDUSTRY = "行业"
PAYLOAD_LOCATIONS = "工作地点"
PAYLOAD_HINTS = "可能对应的大类"
HINT_NAME = "名称"
HINT_CONFIDENCE = "信心"

# Every code point with the Unicode White_Space property.
WHITE_SPACE = (
    "\t\n\u000b\u000c\r \u0085\u00a0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)

# Limits that decide results.
MIN_INTRO_CHARS = 6
RESULT_TEXT_CHARS = 500
PREVIEW_CHARS = 80
REJECT_BELOW = 0.55
DEFAULT_TOP_K = 5
GRAPH_STORED = 10
GRAPH_USED = 5
VECTOR_DIM = 512

PAYLOAD_TYPE = T.StructType(
    [
        T.StructField(PAYLOAD_SUMMARY, T.StringType()),
        T.StructField(PAYLOAD_DUTIES, T.ArrayType(T.StringType())),
        T.StructField(PAYLOAD_SKILLS, T.ArrayType(T.StringType())),
        T.StructField(PAYLOAD_INDUSTRY, T.StringType()),
        T.StructField(PAYLOAD_LOCATIONS, T.ArrayType(T.StringType())),
        T.StructField(
            PAYLOAD_HINTS,
            T.ArrayType(
                T.StructType(
                    [
                        T.StructField(HINT_NAME, T.StringType()),
                        T.StructField(HINT_CONFIDENCE, T.DoubleType()),
                    ]
                )
            ),
        ),
    ]
)

ENRICHMENT_TYPE = T.StructType(
    [
        T.StructField(TAXONOMY_OVERVIEW_FIELD, T.StringType()),
        *[T.StructField(f, T.ArrayType(T.StringType())) for f in TAXONOMY_LIST_FIELDS],
    ]
)

CANDIDATES_TYPE = T.ArrayType(
    T.StructType(
        [
            T.StructField("rank", T.IntegerType()),
            T.StructField("code", T.StringType()),
            T.StructField("cosine", T.DoubleType()),
        ]
    )
)

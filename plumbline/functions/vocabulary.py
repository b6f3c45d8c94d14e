"""Word lists and patterns that decide results.

All entries below are fixed values: texts are matched against them literally.
"""

from __future__ import annotations

# fixed values: numbers in report text
PERCENT = r"(?<![\d.])(\d{1,3}(?:\.\d+)?)\s*%"
NUMBER = r"(?<!\d)(\d{1,3}(?:\.\d+)?)(?!\d)"
CLAUSE_END = "[。；;]"

# fixed values: a rate is not read across the name of another metric
RATE_NAMES = ("就业率", "就业落实率", "毕业去向落实率")
OTHER_METRIC_WORDS = ("升学", "留学", "出国", "出境", "自主创业")

# fixed values: a broad alias counts only without these words in the four characters before it and with a head count after it
BROAD_ALIAS = "升学"
BROAD_ALIAS_NOT_AFTER = ("不含", "除", "国内", "境外", "出国")
BROAD_ALIAS_FOLLOWED_BY = r"^\s*\d+\s*人"

# fixed values: evaluation texts; all words of one group together exclude a line
EVALUATION_CONTEXT = (("满意度", "问卷"), ("满意度", "调查"), ("满意度", "学习收获"), ("学生学习满意度",), ("教育教学整体满意度",))

# fixed values: the sentence that announces a ranking, and what separates its names
RANKING_SENTENCE = r"排行前(\d+)个紧缺职业分别为([^。]+)"
RANKING_SEPARATOR = "[、,，]"

# fixed values: catalog and distribution lines
CATEGORY_LINE = r"^(?:\d{2}\s*)?学科门类：(.+)$"
CLASS_LINE = r"^(\d{4})\s+(.+类)$"
MAJOR_LINE = r"^(\d{6,7}[A-Z]{0,2})\s+(.+)$"
MAJOR_NOTE = r"（注：(.+?)）"
DEGREE_SUFFIX = "学士"
SECTION_LINE = r"^(.*?)（.*）$"
DISTRIBUTION_ROW = r"(\d{2,3})\s+([\d,]+)\s+([\d,]+)"
DISTRIBUTION_NOISE_STARTS = ("页码", "表中的成绩")
DISTRIBUTION_NOISE = ("辽宁省高中等教育招生考试委员会办公室", "成绩统计表")
OCCUPATION_CODE = r"^\d{1,2}(-\d{1,2}){1,3}$"

# fixed value: a major's code in running text
MAJOR_CODE = r"(?<!\d)(\d{4,6}[A-Za-z]?)(?!\d)"

# fixed values: scope tags in order; a rule is a list of (words, tag) of which the first with a word in the quote applies, or a
# pattern and the tag that a match gives, {} being what its group holds
SCOPE_RULES = (
    (r"([0-9０-９]{4})\s*届", "{}届"),
    (
        (("本科应届毕业生",), "本科应届毕业生"),
        (("本科毕业生",), "本科毕业生"),
        (("毕业研究生", "研究生毕业生"), "研究生"),
        (("专科毕业生", "高职"), "专科/高职毕业生"),
        (("毕业生",), "毕业生总体"),
    ),
    ((("辽宁省内", "在辽就业", "辽宁省就业", "留辽"), "辽宁省内去向，不是学校总体就业率或本科总体口径"),),
    ((("专业对口", "对口就业率"), "专业对口口径，不是学校总体就业率或本科总体口径"),),
    (r"(专业毕业生|[\u4e00-\u9fa5]{2,24}专业[^。；;]{0,12}就业率)", "专业口径，不是学校总体就业率或本科总体口径"),
    ((("男生", "女生", "男/女"), "性别分组，不是学校总体就业率或本科总体口径"),),
    ((("师范生", "非师范生"), "培养类型分组，不是学校总体就业率或本科总体口径"),),
    ((("学位点",), "学位点口径，不是学校总体就业率或本科总体口径"),),
    (r"((?:(?:比例|率)[^。；;]{0,12}|较\s*去年[^。；;]{0,6})(?:上升|增长|提高|提升|下降|降低))", "变化幅度，不是学校总体就业率或本科总体口径"),
    ((("国内升学",), "国内升学"), (("升学",), "升学")),
    (
        (("年终",), "年终毕业去向"),
        (("初次",), "初次毕业去向"),
        (("毕业去向落实率",), "毕业去向落实率"),
        (("就业率",), "就业率"),
    ),
    (r"截至\s*((?:[0-9０-９]{4}\s*年\s*)?[0-9０-９]{1,2}\s*月\s*[0-9０-９]{1,2}\s*日)", "截至{}"),
)

# fixed values: characters that text recognition confuses with digits
DIGIT_LOOKALIKES = ("OoоIl", "00011")

# fixed values: file endings of attachments, and of those that a viewer's address may name
FILE_ENDINGS = (".pdf", ".ofd", ".doc", ".docx", ".zip")
REPORT_ENDINGS = (".pdf", ".ofd", ".doc", ".docx")

# fixed values: where pages name attachments besides their anchors
VIEWER_PARAMETERS = ("fileUrl", "fileurl")
VIEWER_CALL = r"(?i)showVsbpdfIframe\(\s*['\"]([^'\"]+\.pdf(?:\?[^'\"]*)?)['\"]"
CLOUD_NAME = r'name=\\*"([^"\\]+)\\*"'
CLOUD_ENTRY = "att_clouddisk"
CLOUD_ADDRESSES = ("downPath", "playUrl")

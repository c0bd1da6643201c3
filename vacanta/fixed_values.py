"""Values that results must agree on with the collected data and its reports.

Everything here is a fixed value: codes, names, patterns, limits and message
texts. No logic lives in this module.
"""

# --- fixed values: listing columns, in output order -------------------------
LISTING_COLUMNS = [
    "jobId", "jobType", "jobName", "jobTags", "workAreaCode", "jobAreaCode",
    "jobAreaString", "hrefAreaPinYin", "provideSalaryString", "issueDateString",
    "confirmDateString", "workYear", "workYearString", "degreeString",
    "industryType1", "industryType2", "industryType1Str", "industryType2Str",
    "major1Str", "companyName", "fullCompanyName", "companyLogo",
    "companyTypeString", "companySizeString", "companySizeCode",
    "companyIndustryType1Str", "companyIndustryType2Str", "hrUid", "hrName",
    "smallHrLogoUrl", "hrPosition", "hrLabels", "updateDateTime", "lon", "lat",
    "jobHref", "jobDescribe", "companyHref", "term", "termStr",
    "jobTagsForOrder", "jobSalaryMax", "jobSalaryMin", "isReprintJob",
    "applyTimeText", "jobReleaseType", "coId", "search_kw", "search_city",
]
LIST_COLUMNS = ["jobTags", "hrLabels", "jobTagsForOrder"]
SALARY_COLUMNS = ["jobSalaryMax", "jobSalaryMin"]

# --- fixed values: areas -----------------------------------------------------
AREAS = {
    "010000": "北京", "020000": "上海", "030000": "广东省", "040000": "深圳",
    "050000": "天津", "060000": "重庆", "070000": "江苏省", "080000": "浙江省",
    "090000": "四川省", "100000": "海南省", "110000": "福建省", "120000": "山东省",
    "130000": "江西省", "140000": "广西", "150000": "安徽省", "160000": "河北省",
    "170000": "河南省", "180000": "湖北省", "190000": "湖南省", "200000": "陕西省",
    "210000": "山西省", "220000": "黑龙江省", "230000": "辽宁省", "240000": "吉林省",
    "250000": "云南省", "260000": "贵州省", "270000": "甘肃省", "280000": "内蒙古",
    "290000": "宁夏", "300000": "西藏", "310000": "新疆", "320000": "青海省",
}
ALL_AREAS = "000000"

# --- fixed values: responses -------------------------------------------------
SUCCESS_STATUS = "1"
BLOCKED_CODES = [403, 429, 503, 521]
ANTI_SPIDER = "anti_spider_suspected"
CHALLENGE_PATTERN = r"var arg1='([A-F0-9]+)';"
ERROR_WORD = "error"
MIN_ITEMS_PER_PAGE = 1
PAGE_SIZE = 20
DEFAULT_MAX_PAGE = 10
INSERT_BATCH = 1000

# --- fixed values: request monitoring ---------------------------------------
ANTI_SPIDER_WORDS = ["anti_spider", "blocked"]
RESPONSE_TIMES_KEPT = 100
RECENT_HOURS = 24
REPORT_EVERY_TASKS = 5
CRITICAL, NORMAL = "CRITICAL", "NORMAL"
HEALTH_STREAK, HEALTH_STREAK_LIMIT = "连续失败次数过多", 10
HEALTH_RATE, HEALTH_RATE_LIMIT, HEALTH_RATE_MIN_REQUESTS = "成功率过低", 30, 20
HEALTH_ANTI, HEALTH_ANTI_LIMIT, HEALTH_ANTI_MIN_REQUESTS = "反爬虫命中率过高", 0.5, 10
HEALTH_SILENT, HEALTH_SILENT_HOURS = "长时间无成功请求", 1
HEALTH_GOOD = "健康状况良好"
ADVICE_RATE, ADVICE_RATE_LIMIT = "成功率较低，建议增加请求间隔时间", 50
ADVICE_ANTI, ADVICE_ANTI_LIMIT = "反爬虫命中率高，建议更换User-Agent或增加代理", 30
ADVICE_EMPTY, ADVICE_EMPTY_LIMIT = "空响应率高，可能需要调整搜索参数或检查目标网站变化", 50
ADVICE_SLOW, ADVICE_SLOW_LIMIT = "平均响应时间较长，建议检查网络状况或减少并发", 10

# --- fixed values: store checks ----------------------------------------------
ERRORS_KEPT, ERRORS_SHOWN, ERRORS_ANALYSED = 50, 5, 10
ALERT_STREAK = 3
SLOW_CHECK_SECONDS = 5.0
ERROR_PATTERNS = ["timeout", "connection", "operational"]
FINDING_RATE_LIMIT = 90
FINDING_STREAK = "当前连续失败 %d 次"
FINDING_RATE = "成功率较低: %s%%"
FINDING_PATTERNS = "错误类型分析:"
FINDING_PATTERN = "  %s: %d 次"
ADVICE_STREAK = ["建议检查MySQL服务器状态", "检查网络连接", "检查数据库配置"]
ADVICE_TIMEOUT_WORD = "timeout"
ADVICE_TIMEOUT = ["考虑增加连接超时时间", "检查数据库服务器负载"]

"""Category values and thresholds. The values are part of the results and are kept literally."""

from __future__ import annotations

from dataclasses import dataclass

# fixed values: labels of the business
YES, NO, UNKNOWN, NONE, OTHER, TOTAL = "是", "否", "未知", "无", "其他", "总体"
NULL_TEXTS = ("", "nan", "NaN", "None", "NONE", "无", "无效")
YES_TEXTS = ("是", "true", "1", "yes", "y")
WEEKDAYS = ("星期一", "星期二", "星期三", "星期四", "星期五", "星期六", "星期日")
PERIODS = ("凌晨（0:00-5:59）", "上午（6:00-11:59）", "下午（12:00-17:59）", "晚上（18:00-23:59）")
RETIRED = "退运"  #: status of stations that are left out
ALL_STATIONS = "全部场站"
CURVES = ("公共场站", "高速")  #: categories that have a density curve beside that of all stations
SHORT_PERIODS = ("凌晨", "上午", "下午", "晚上")
CATEGORIES = ("高速", "公共场站", "专用场站", "公交场站", "其他")
CATEGORY_PRIORITY = ("高速", "公交场站", "专用场站", "公共场站", "其他")
BUS = "公交场站"
STATION_TYPES = {"高速": ("高速",), "公共场站": ("城市公共",), "专用场站": ("单位内部（专用）", "单位内部(专用)", "单位内部", "专用"), "公交场站": ("公交", "公交场站")}

# fixed values: bounds and names of the buckets
DURATION_13 = ((10, "0-10min"), (20, "10-20min"), (30, "20-30min"), (40, "30-40min"), (50, "40-50min"), (60, "50-60min"), (90, "60-90min"), (120, "90-120min"), (180, "120-180min"), (240, "180-240min"), (360, "240-360min"), (720, "360-720min"))
DURATION_OVER = "720min以上"
DURATION_DETAIL = ((10, "0-10min"), (20, "10-20min"), (30, "20-30min"), (40, "30-40min"), (60, "40-60min"), (90, "60-90min"), (120, "90-120min"), (180, "120-180min"), (240, "180-240min"), (None, "240min以上"))
DURATION_CORE = ((10, "0-10min"), (20, "10-20min"), (30, "20-30min"), (60, "30-60min"), (120, "60-120min"), (None, "120min以上"))
ENERGY = ((10, "0-10kWh"), (20, "10-20kWh"), (40, "20-40kWh"), (60, "40-60kWh"), (80, "60-80kWh"), (None, "80kWh以上"))
ENERGY_MATRIX = ((10, "0-10kWh"), (20, "10-20kWh"), (40, "20-40kWh"), (60, "40-60kWh"), (None, "60kWh以上"))
GAPS = ((6, "0-6h"), (24, "6-24h"), (72, "1-3天"), (168, "3-7天"), (336, "7-14天"), (None, "14天以上"))
FIRST = "首次"
ENERGY_TYPES = ("短时低电量", "短时高电量", "常规补能", "长时高电量", "长时低电量")

# fixed values: classes of end reasons and the words that tell them
END_NORMAL, END_USER, END_AMOUNT, END_SYSTEM, END_FAULT, END_OTHER = "正常结束", "用户主动停止", "金额/SOC达到", "后台/系统结束", "故障异常", "其他原因"
END_WORDS = (
    (END_NORMAL, ("电动汽车充满", "充满停止", "达到SOC", "022AH", "BMS 正常", "BMS正常", "达到涓流充电停机条件", "预付金额不足", "达到设置充电电量停止", "本地停止充电")),
    (END_USER, ("用户远程", "用户在充电桩", "APP停止", "用户拔枪", "车端S2主动断开")),
    (END_AMOUNT, ("预充金额用完", "达到设置充电金额", "金额停止")),
    (END_SYSTEM, ("后台停止", "系统自动结束", "订单超过48小时")),
    (END_FAULT, ("故障", "异常", "超时", "绝缘", "控制导引", "报文", "接触器", "输入电源", "连接故障", "BST", "BRM", "022CH", "022BH", "0253H", "010EH", "013DH", "0205H")),
)
END_CODES = ("0253H", "024E", "0241", "022C")
ABNORMAL_WORDS = ("异常", "失败", "取消", "撤销", "作废", "无效")
NORMAL_WORDS = ("正常结束", "正常终止", "主动终止", "用户主动", "用户终止", "人工终止", "手动终止", "已完成", "完成", "金额", "SOC", "soc", "余额", "费用", "封顶", "达到")

# fixed values: reasons of the discard rules, in the order of the rules
DISCARD_REASONS = ("订单状态选择", "交易电量大于800", "抄表电量大于800", "电费大于500", "服务费大于500", "交易金额大于800", "交易电量小于0", "电费/电量大于4", "抄表电量小于0", "充电时长小于0秒", "电量小于0.1且总费用不为0", "充电时长大于0但电量小于0.1", "充电量和抄表电量误差大于0.1", "分时电量和充电量误差大于0.1", "充电时长大于18小时", "充电开始或结束时间缺失", "充电开始时间超出范围")

# fixed values: the day on which the tariff changes, the months of the season, and
# tariff: (hour from, hour to) of each segment
TARIFF_CHANGE = "2025-07-01"
TARIFFS = {
    "legacy": {"peak": ((8, 11), (17, 22)), "flat": ((11, 17), (22, 24)), "valley": ((0, 8),)},
    "summer_winter": {"peak": ((14, 22),), "flat": ((6, 11), (13, 14), (22, 24)), "valley": ((0, 6), (11, 13))},
    "other": {"peak": ((15, 22),), "flat": ((0, 2), (6, 10), (14, 15), (22, 24)), "valley": ((2, 6), (10, 14))},
}
SEASON_MONTHS = (6, 7, 8, 12, 1, 2)

# fixed values: names of levels, types, states and segments
R_LEVELS = ("活跃", "近期活跃", "一般活跃", "沉默风险", "沉默")
F_LEVELS = ("高频", "中高频", "中频", "低频", "极低频")
M_LEVELS = ("极低价值", "低价值", "中价值", "中高价值", "高价值")
HV_ACTIVE, HV_RISK, NEW_LOW, HIGH_LOW, LOW_LOW, GENERAL = "高价值活跃用户", "高价值沉默风险用户", "新近低频用户", "高频低价值用户", "低频低价值用户", "一般用户"
TOO_FEW = "样本不足"
STABLE, RETURNING, EXITED, SILENT = "稳定高价值活跃", "回流高价值活跃", "历史高价值活跃", "沉默高价值活跃"
LEGACY_STATES = {"历史高价值活跃（当前已退出）": EXITED}
SEGMENTS = (("01", "新用户"), ("02", "回流非高价值活跃用户"), ("03", "稳定高价值活跃用户"), ("04", "回流高价值活跃用户"), ("05", "历史高价值活跃用户"), ("06", "新近低频用户"), ("07", "高价值沉默风险用户"), ("08", "高频低价值用户"), ("09", "低频低价值用户"), ("10", "沉默高价值活跃"), ("11", "一般用户"))
PASS, FAIL, WARN = "通过", "未通过", "告警"

# fixed values: coupon of each segment and range of silence tiers (0: charged within a week): segment, first and last tier, mark
# (LOST: was of high value before), coupon, largest amount in yuan, days that it holds
LOST = "lost"
COUPON_RULES = (
    ("01", 0, 5, "", "新手成长任务券", 5, 7), ("02", 0, 5, "", "满减券", 5, 15), ("03", 0, 5, "", "月度阶梯折扣", 8, 7), ("04", 0, 5, "", "满减券", 15, 7),
    ("05", 0, 2, "", "满减券", 15, 15), ("05", 3, 5, "", "满减券", 15, 30), ("06", 0, 5, "", "阶梯任务券", 5, 7), ("07", 0, 2, "", "满减券", 15, 15), ("07", 3, 5, "", "满减券", 15, 30),
    ("08", 0, 5, "", "谷段时长折扣券", 2, 7), ("09", 0, 2, "", "阶梯任务券", 3, 7), ("09", 3, 3, "", "甲方券包", 20, 30), ("09", 4, 4, "", "甲方券包", 30, 30), ("09", 5, 5, "", "阶梯任务券", 3, 7),
    ("10", 0, 5, "", "甲方券包", 40, 30), ("11", 1, 1, "", "甲方券包", 5, 7), ("11", 2, 2, "", "甲方券包", 10, 15), ("11", 3, 3, "", "甲方券包", 20, 30), ("11", 4, 4, "", "甲方券包", 30, 30), ("11", 5, 5, "", "甲方券包", 40, 30),
    ("11", 0, 2, LOST, "满减券", 15, 15), ("11", 3, 5, LOST, "满减券", 15, 30),
)
# fixed values: the amounts in yuan, coupons that give way to a discount coupon, and which is sent first (segment, tiers, place)
AMOUNTS = (2, 3, 5, 8, 10, 15, 20, 30, 40)
GIVES_WAY, DISCOUNT_COUPON = ("满减券", "甲方券包"), "折扣券"
TOUCH_ORDER = (("05", 1, 2, 1), ("03", 1, 1, 2), ("04", 1, 1, 2), ("05", 3, 4, 3), ("10", 0, 5, 4), ("06", 1, 1, 5), ("08", 1, 1, 5), ("11", 1, 5, 6), ("09", 0, 5, 7))


@dataclass(frozen=True)
class CleanRules:
    cutoff: str = "2026-07-31 23:59:59"
    earliest: str = "2020-01-01 00:00:00"
    restart_seconds: int = 600
    partition_by_source: bool = False


@dataclass(frozen=True)
class Windows:
    days: int = 90
    step: int = 1
    horizon: int = 180
    start: str | None = None


@dataclass(frozen=True)
class ListRules:
    horizon: int = 180
    new_days: int = 7
    return_gap: int = 30
    abnormal_days: int = 14


@dataclass(frozen=True)
class SegmentRules:
    min_orders: int = 3
    coupon: tuple = (0.5, 0.2)
    valley: tuple = (0.5, 0.25)
    core: tuple = ("01", "02", "03", "04", "05", "06", "07")

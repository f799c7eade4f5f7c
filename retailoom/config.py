"""Business constants, in one place."""

# --- fixed values: they decide the results and must not be changed -------------------------------

ORDER_FINISHED = "已完成"
ORDER_SHIPPED = "已发货"
COMPLETED = (ORDER_FINISHED, ORDER_SHIPPED)

PAID_SOURCE = "付费推广"
FLOW_PAID = "付费"
FLOW_NATURAL = "自然"

STOCK_IN = "入库"
STOCK_OUT = "出库"
INITIAL_STOCK_REMARK = "初始库存"

# (exclusive upper age, label); an age at or above the last bound, or no age at all, is AGE_REST
AGE_BANDS = ((18, "未成年"), (26, "18-25岁"), (36, "26-35岁"), (46, "36-45岁"), (56, "46-55岁"))
AGE_REST = "55岁以上"

# looked for in the store name, first hit wins
STORE_TYPES = ("旗舰店", "专卖店", "直营店")
STORE_TYPE_REST = "普通店"

WEEKDAY_NAMES = ("周一", "周二", "周三", "周四", "周五", "周六", "周日")

# (spent at least, level)
USER_LEVELS = ((10000, "高价值"), (5000, "中价值"))
USER_LEVEL_REST = "低价值"

BULKY_CATEGORY_PREFIX = "整车"
FREIGHT_BULKY = 30
FREIGHT_OTHER = 3

AFTER_SALE_FEE = "0.02"
PLATFORM_FEE = "0.05"
MANAGEMENT_FEE = "0.10"

# conversion-rate range of a product tier, in 1/10000
TIER_CONVERSION = {
    "畅销品": (300, 800),
    "利润品": (100, 300),
    "主推新品": (200, 500),
    "滞销品": (50, 150),
    "引流品": (400, 1000),
}
TIER_CONVERSION_REST = (200, 500)

CONSISTENCY_TOLERANCE = "1.0"

DATE_DIM_DAYS = 1096

# days before and after are taken for typing errors: no calendar day is made for them
CALENDAR_FIRST_DAY = "1900-01-01"
CALENDAR_LAST_DAY = "2199-12-31"

# --- scale ---------------------------------------------------------------------------------------

# remainders of a day fall into this many ranges when left-over orders are shared out
REMAINDER_RANGES = 4096

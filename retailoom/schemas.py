"""Columns of the raw tables and labels of the report tables."""

from pyspark.sql import types as T

# --- fixed values: headers of the raw files, in file order, with the column name and type they get ----

RAW_COLUMNS: dict[str, tuple[tuple[str, str, str], ...]] = {
    "ods_stores": (
        ("店铺ID", "store_id", "string"),
        ("店铺名称", "store_name", "string"),
        ("店铺类型", "store_type", "string"),
        ("平台", "platform", "string"),
        ("开店日期", "open_date", "date"),
    ),
    "ods_products": (
        ("SKU_ID", "sku_id", "string"),
        ("商品ID", "product_id", "string"),
        ("产品编码", "product_code", "string"),
        ("规格编码", "spec_code", "string"),
        ("店铺ID", "store_id", "string"),
        ("平台", "platform", "string"),
        ("商品名称", "product_name", "string"),
        ("规格", "spec", "string"),
        ("一级类目", "category_l1", "string"),
        ("二级类目", "category_l2", "string"),
        ("商品分层", "product_tier", "string"),
        ("售价", "price", "decimal(10,2)"),
        ("成本", "cost", "decimal(10,2)"),
        ("库存", "stock", "int"),
        ("创建时间", "create_time", "date"),
    ),
    "ods_users": (
        ("用户ID", "user_id", "string"),
        ("用户名", "user_name", "string"),
        ("性别", "gender", "string"),
        ("年龄", "age", "int"),
        ("城市", "city", "string"),
        ("注册日期", "register_date", "date"),
    ),
    "ods_orders": (
        ("订单ID", "order_id", "string"),
        ("用户ID", "user_id", "string"),
        ("店铺ID", "store_id", "string"),
        ("平台", "platform", "string"),
        ("下单时间", "order_time", "timestamp"),
        ("订单状态", "order_status", "string"),
        ("商品总额", "total_amount", "decimal(12,2)"),
        ("优惠金额", "discount_amount", "decimal(12,2)"),
        ("运费", "shipping_fee", "decimal(12,2)"),
        ("实付金额", "final_amount", "decimal(12,2)"),
        ("成本总额", "total_cost", "decimal(12,2)"),
        ("支付方式", "payment_method", "string"),
        ("流量来源", "traffic_source", "string"),
        ("创建时间", "create_time", "timestamp"),
        ("更新时间", "update_time", "timestamp"),
    ),
    "ods_order_details": (
        ("订单明细ID", "order_detail_id", "string"),
        ("订单ID", "order_id", "string"),
        ("SKU_ID", "sku_id", "string"),
        ("商品ID", "product_id", "string"),
        ("数量", "quantity", "int"),
        ("单价", "price", "decimal(10,2)"),
        ("金额", "amount", "decimal(12,2)"),
    ),
    "ods_promotion": (
        ("推广ID", "promotion_id", "string"),
        ("日期", "date", "date"),
        ("店铺ID", "store_id", "string"),
        ("平台", "platform", "string"),
        ("SKU_ID", "sku_id", "string"),
        ("商品ID", "product_id", "string"),
        ("一级类目", "category_l1", "string"),
        ("二级类目", "category_l2", "string"),
        ("推广渠道", "channel", "string"),
        ("推广花费", "cost", "decimal(10,2)"),
        ("曝光量", "impressions", "int"),
        ("点击量", "clicks", "int"),
        ("点击率", "ctr", "decimal(9,2)"),
    ),
    "ods_traffic": (
        ("日期", "date", "date"),
        ("店铺ID", "store_id", "string"),
        ("平台", "platform", "string"),
        ("访客数", "visitors", "int"),
        ("浏览量", "page_views", "int"),
        ("搜索流量", "search_traffic", "int"),
        ("推荐流量", "recommend_traffic", "int"),
        ("直接访问", "direct_traffic", "int"),
        ("其他流量", "other_traffic", "int"),
        ("平均停留时长", "avg_stay_time", "decimal(10,2)"),
        ("跳失率", "bounce_rate", "decimal(5,2)"),
    ),
    "ods_inventory": (
        ("库存记录ID", "inventory_id", "string"),
        ("日期", "date", "date"),
        ("SKU_ID", "sku_id", "string"),
        ("商品ID", "product_id", "string"),
        ("店铺ID", "store_id", "string"),
        ("变动类型", "change_type", "string"),
        ("变动数量", "change_quantity", "int"),
        ("变动后库存", "stock_quantity", "int"),
        ("备注", "remark", "string"),
    ),
    "ods_product_traffic": (
        ("流量ID", "traffic_id", "string"),
        ("日期", "date", "date"),
        ("店铺ID", "store_id", "string"),
        ("平台", "platform", "string"),
        ("SKU_ID", "sku_id", "string"),
        ("商品ID", "product_id", "string"),
        ("一级类目", "category_l1", "string"),
        ("二级类目", "category_l2", "string"),
        ("流量渠道", "channel", "string"),
        ("曝光量", "impressions", "int"),
        ("点击量", "clicks", "int"),
        ("收藏量", "favorites", "int"),
        ("加购量", "add_to_cart", "int"),
        ("点击率", "ctr", "decimal(9,2)"),
    ),
}

# --- fixed values: what identifies a row of a raw table; a table without such a key is delivered by whole days --------

RAW_KEYS: dict[str, tuple[str, ...]] = {
    "ods_stores": ("store_id",),
    "ods_products": ("sku_id",),
    "ods_users": ("user_id",),
    "ods_orders": ("order_id",),
    "ods_order_details": ("order_detail_id",),
    "ods_promotion": ("promotion_id",),
    "ods_traffic": ("date", "store_id"),
    "ods_inventory": ("inventory_id",),
    "ods_product_traffic": ("traffic_id",),
}

# --- fixed values: column labels under which the reports are handed out -------------------------------

REPORT_LABELS: dict[str, dict[str, str]] = {
    "daily_report": {
        "date": "日期",
        "platform": "平台",
        "store_name": "店铺",
        "product_id": "SPU编码",
        "sku_id": "SKU编码",
        "product_name": "商品名称",
        "spec": "规格",
        "category_l1": "一级类目",
        "category_l2": "二级类目",
        "order_count": "订单数",
        "customer_count": "客户数",
        "quantity": "销量",
        "sales_amount": "销售额",
        "cost_amount": "商品成本",
        "freight": "运费",
        "gross_profit": "毛利",
        "gross_rate": "毛利率",
        "promo_cost": "推广费",
        "after_sale_fee": "售后费",
        "platform_fee": "平台费",
        "management_fee": "管理费",
        "net_profit": "净利润",
        "net_rate": "净利率",
        "avg_order_value": "客单价",
    },
    "platform_summary": {
        "platform": "平台",
        "store_count": "店铺数",
        "order_count": "总订单数",
        "customer_count": "总客户数",
        "sales_amount": "总销售额",
        "cost_amount": "总成本",
        "gross_profit": "总毛利",
        "promo_cost": "总推广费",
        "net_profit": "总净利润",
        "net_rate": "净利率",
        "avg_order_value": "客单价",
    },
    "store_ranking": {
        "platform": "平台",
        "store_name": "店铺",
        "order_count": "总订单数",
        "sales_amount": "总销售额",
        "net_profit": "总净利润",
        "net_rate": "净利率",
        "sales_rank": "销售排名",
        "profit_rank": "利润排名",
    },
    "traffic_report": {
        "date": "日期",
        "platform": "平台",
        "store_name": "店铺",
        "product_id": "SPU编码",
        "category_l1": "一级类目",
        "category_l2": "二级类目",
        "flow_type": "流量类型",
        "impressions": "曝光量",
        "clicks": "点击量",
        "click_rate": "点击率",
        "favorites": "收藏量",
        "add_to_cart": "加购量",
        "sales_quantity": "销量",
        "sales_amount": "销售额",
        "conversion_rate": "点击转化率",
        "cost": "推广费用",
        "avg_click_cost": "平均点击成本",
        "roi": "ROI",
    },
}

# --- fixed values: what counts as a missing value in a raw file, besides an empty field ----------------

MISSING = ("NaN", "nan", "NULL", "null", "None", "NA", "N/A", "n/a", "<NA>", "#N/A", "-NaN", "-nan")


def raw_schema(table: str) -> T.StructType:
    ddl = ", ".join(f"`{name}` {kind}" for _, name, kind in RAW_COLUMNS[table])
    return T.StructType.fromDDL(ddl)


def column_names(table: str) -> dict[str, str]:
    """Header -> column name; empty for tables without a map."""
    return {header: name for header, name, _ in RAW_COLUMNS.get(table, ())}

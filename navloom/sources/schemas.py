"""Column names of the landed tables: source header -> our snake_case name.

Fixed values: the headers must equal those of the landed CSV files.
"""

from __future__ import annotations

from pyspark.sql import types as T

PURCHASE = {
    "基金代码": "fund_code",
    "基金简称": "short_name",
    "申购状态": "subscribe_status",
    "赎回状态": "redeem_status",
    "下一开放日": "next_open_day",
    "购买起点": "purchase_min_amount",
    "日累计限定金额": "daily_limit_amount",
    "手续费": "purchase_fee",
}

OVERVIEW = {
    "基金代码": "fund_code",
    "基金简称": "short_name",
    "基金全称": "full_name",
    "基金类型": "fund_type",
    "发行日期": "issue_date",
    "成立日期/规模": "inception_text",
    "资产规模": "asset_scale",
    "份额规模": "share_scale",
    "基金管理人": "manager_co",
    "基金托管人": "custodian",
    "基金经理人": "manager",
    "成立来分红": "dividends_text",
    "管理费率": "mgmt_fee",
    "托管费率": "custody_fee",
    "销售服务费率": "sales_fee",
    "最高认购费率": "max_subscribe_fee",
    "业绩比较基准": "benchmark",
    "跟踪标的": "tracking",
}

# The source calls the asset scale by this header; it lands under the name above.
OVERVIEW_SOURCE_ASSET_SCALE = "净资产规模"
OVERVIEW_LANDED = {**OVERVIEW, OVERVIEW_SOURCE_ASSET_SCALE: "net_asset_scale"}

NAV = {"基金代码": "fund_code", "净值日期": "nav_date", "单位净值": "unit_nav", "日增长率": "daily_growth"}

BONUS = {
    "基金代码": "fund_code",
    "年份": "year",
    "权益登记日": "record_date",
    "除息日": "ex_date",
    "每份分红": "per_share_text",
    "分红发放日": "pay_date",
}

SPLIT = {
    "基金代码": "fund_code",
    "年份": "year",
    "拆分折算日": "split_date",
    "拆分类型": "split_type",
    "拆分折算比例": "ratio_text",
}

PERSONNEL = {
    "基金代码": "fund_code",
    "公告标题": "title",
    "基金名称": "fund_name",
    "公告日期": "notice_date",
    "报告ID": "report_id",
}

CUM_RETURN = {"基金代码": "fund_code", "日期": "date", "累计收益率": "cum_return_pct"}

ADJUSTED_NAV = {
    "基金代码": "fund_code",
    "净值日期": "nav_date",
    "单位净值": "unit_nav",
    "复权净值": "adjusted_nav",
    "cumulative_factor": "cumulative_factor",
}

CALENDAR = {"trade_date": "trade_date"}

FAILURE_LOG = T.StructType(
    [T.StructField(name, T.StringType()) for name in ("ts", "stage", "code", "error")]
)


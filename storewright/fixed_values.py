"""Literals of the source systems that the results depend on.

They are data, not logic. Every one of them is only a default of a config
field or a rename map and can be replaced by the caller.
"""

# --- member conversion -------------------------------------------------------
AGENT_STORE_TYPE = "代理店"
OWN_LABEL = "自营"
AGENT_LABEL = "代理"
ACTIVATED_FLAG = "是"
CHANNELS = ("智慧云店", "智能中台", "中台")
EXCLUDED_CLASSES = ("其他", "促销物料")
EXCLUDED_SKUS = (
    "SHG30000905",
    "Q3G30000105",
    "QQG30000091",
    "QQG30000090",
    "SHG30000943",
    "SHG30001192",
)
EXCLUDED_GUIDES = ("84e67d1115c859c336", "2f7e946583048a96fe")
EXCLUDED_REGION = "营销管理部"
LAGGING_SUBREGIONS = 20

# Source column -> our column, one map per source table.
SHOP_COLUMNS = {
    "大区名称": "region",
    "小区名称": "subregion",
    "门店类型": "store_type",
    "门店代码": "store_code",
    "门店名称": "store_name",
}
MEMBER_COLUMNS = {
    "会员号": "member_id",
    "服务门店": "service_store",
    "注册时间": "registered_at",
    "微信unionId": "union_id",
    "是否在云店上激活": "activated",
}
PURCHASE_COLUMNS = {
    "会员号": "member_id",
    "商品代码": "sku",
    "来源": "channel",
    "消费时间": "purchased_at",
    "金额": "amount",
}
GOODS_COLUMNS = {"商品代码": "sku", "二级大类": "goods_class"}
CONTACT_COLUMNS = {"企微unionId": "union_id", "企微添加时间": "added_at"}
FOLLOWER_COLUMNS = {
    "firstShopCode": "first_shop_code",
    "mobile": "mobile",
    "date_add": "followed_at",
    "firstguideno": "guide_no",
}

# --- session labels ----------------------------------------------------------
SESSION_COLUMNS = {"最后接待客服": "last_agent", "会话详情内容": "transcript"}
SERVICE_TOPICS = ("会员权益", "产品质量", "优惠券使用", "产品维修", "顾客投诉")
OTHER_CATEGORY = "其他"
FAILED_IS_SERVICE = "否"
FAILED_CATEGORY = "获取失败"
IS_SERVICE_DESCRIPTION = (
    "判断文本内容是否涉及'会员权益'，'产品质量'，'优惠券使用'，'产品维修'，'顾客投诉'，属于则返回1，不属于返回0"
)
CATEGORY_DESCRIPTION = (
    "判断文本内容属于'会员权益'，'产品质量'，'优惠券使用'，'产品维修'，'顾客投诉'中的哪一种，返回'其他'"
)
# The prompt around the two slots, and the public answer-format text that goes
# into the first one.
PROMPT_TEMPLATE = """
    You will be given a poorly formatted string from a user.
    Reformat it and make sure all the words are spelled correctly,all output in Chinese
    {format_instructions}
    % USER INPUT:
    {user_input}
    YOUR RESPONSE:
    """
FORMAT_INSTRUCTIONS_HEAD = (
    "The output should be a markdown code snippet formatted in the following schema, "
    'including the leading and trailing "```json" and "```":'
)

# --- gift stock --------------------------------------------------------------
STOCK_COLUMNS = {
    "门店代码": "store_code",
    "商品代码": "sku",
    "实时上架库存（包含虚拟）": "shelf_stock",
    "门店实时库存（剔除未核销）": "store_stock",
}
# Columns of a stock export that no figure is taken from.
UNUSED_STOCK_COLUMNS = (
    "门店实物库存（包含未核销）",
    "期初实物库存数",
    "在途数",
    "本月入库实物数",
    "本月入库虚拟数",
    "本月出库数",
    "本月下单数",
    "本月之前下单未核销数",
    "本月下单未核销数",
    "本月下单已核销数",
    "本月盘盈亏数",
)
REAL_STOCK_MODE = "真实库存"
WAREHOUSE_CODE = "STZBZC"
ADJUST_TYPE = "虚拟库存"
ADJUSTMENT_HEADERS = {
    "warehouse_code": "仓库代码",
    "store_code": "门店代码",
    "sku": "69码/版库号",
    "adjust_qty": "库存",
    "adjust_type": "类型（实际库存，虚拟库存，虚拟替换）",
    "courier": "快递公司",
    "tracking_no": "快递单号",
    "receiver_contact": "收件人联系方式",
    "remark": "备注",
    "sub_order_no": "子订单号",
}

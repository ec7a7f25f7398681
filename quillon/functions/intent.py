"""Rule-based labels of device commands: one first-match chain of native columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from quillon.functions.text import compact, has_any, let

# Id, intent, name and required slot of each capability.
CAPABILITIES = [
    (1, "call_manager", "呼叫管理员", None),
    (2, "call_contact", "呼叫联系人", "contact"),
    (3, "answer_call", "接听来电", None),
    (4, "unlock", "开锁", None),
    (5, "end_or_reject_call", "拒接/挂断", "action"),
    (6, "change_wallpaper", "更换壁纸", "wallpaper_type"),
    (7, "set_dnd", "切换勿扰模式", "enabled"),
    (8, "set_volume", "调节音量", "adjustment"),
    (9, "set_brightness", "调节屏幕亮度", "adjustment"),
    (10, "set_security_mode", "布防/撤防", "enabled"),
    (11, "query_alarm_records", "查询告警记录", None),
    (12, "monitor_control", "监控管理", "action"),
    (13, "view_messages", "查看通知/短信", None),
]

# Keywords of each rule in the order in which they are tried, with the confidence.
RULES = [
    ("call_manager", 0.95, ["管理员", "物业", "物管"]),
    ("answer_call", 0.95, ["接听", "接电话", "接一下", "接来电"]),
    ("reject", 0.95, ["拒接", "拒绝来电", "别接"]),
    ("hangup", 0.95, ["挂断", "挂电话", "挂了", "结束通话"]),
    ("unlock", 0.95, ["开锁", "打开门锁", "远程开门", "开门"]),
    ("change_wallpaper", 0.9, ["壁纸"]),
    ("set_dnd", 0.9, ["勿扰", "免打扰"]),
    ("set_volume", 0.9, ["音量", "声音", "静音"]),
    ("set_brightness", 0.9, ["亮度", "屏幕亮", "屏幕暗", "调亮", "调暗"]),
    ("set_security_mode", 0.9, ["布防", "撤防", "安防"]),
    ("query_alarm_records", 0.9, ["告警", "报警"]),
    ("monitor_control", 0.9, ["监控", "摄像头", "录像", "通道", "画面", "场景"]),
    ("view_messages", 0.9, ["通知", "短信", "消息"]),
    ("call_contact", 0.8, ["打电话", "拨打", "呼叫", "联系"]),
]

# Words that set a slot.
WALLPAPERS = ["风景", "默认", "家庭", "节日", "卡通", "纯色", "深色", "浅色"]
SCENES = ["门口", "客厅", "卧室", "电梯", "走廊", "车库"]
RANGES = ["今天", "昨天", "前天", "最近一周", "近一周", "最近三天", "这个月", "上个月"]
ON, OFF = ["开启", "打开", "启用", "开一下", "设为"], ["关闭", "取消", "关掉", "停用"]
ARM, DISARM = ["布防", "开启安防", "打开安防"], ["撤防", "关闭安防", "取消安防"]
TOP, BOTTOM = ["最大", "最高", "最亮"], ["最小", "最低", "最暗"]
UP = ["调高", "调大", "大一点", "高一点", "亮一点", "调亮", "增加", "提高", "升高"]
DOWN = ["调低", "调小", "小一点", "低一点", "暗一点", "调暗", "降低", "减小", "减低"]
MONITOR = [("open", ["打开", "开启"]), ("close", ["关闭", "关掉"]), ("playback", ["回放", "录像"]), ("switch_channel", ["切换", "换到"]), ("view", ["查看", "看一下", "看看"])]
CONTACTS = [("family", ["家人"]), ("frequent_contacts", ["常用联系人"]), ("service_phone", ["服务电话"])]
CONTACT = r"(?:给|帮我给|拨打|呼叫|联系)([^，。！？、]+?)(?:打电话|电话|$)"


def _pick(t: Column, choices: list[tuple[object, list[str]]]) -> Column:
    """The value of the first choice that has a word in the text, or null."""
    return F.coalesce(*[F.when(has_any(t, words), F.lit(value)) for value, words in choices])


def _which(t: Column, words: list[str]) -> Column:
    return _pick(t, [(w, [w]) for w in words])


def rule_of(t: Column) -> Column:
    """Name of the first rule that matches a compact text, or null."""
    return _pick(t, [(name, words) for name, _, words in RULES])


def device_label(text: Column) -> Column:
    """Struct of ``capability_id``, ``capability``, ``intent``, ``slots`` (a map of texts), ``missing_slots`` and ``confidence``."""
    return let(compact(text), lambda t: let(rule_of(t), lambda rule: _label(t, rule)))


def _label(t: Column, rule: Column) -> Column:
    """``device_label`` of a compact text and the rule that it matches."""
    intent = F.when(rule.isin("reject", "hangup"), "end_or_reject_call").otherwise(rule)
    number = F.nullif(F.regexp_extract(t, r"(\d{1,3})", 1), F.lit("")).cast("int")
    named = F.nullif(F.trim(F.regexp_extract(t, CONTACT, 1)), F.lit(""))
    is_level = rule.isin("set_volume", "set_brightness")
    level = F.coalesce(_pick(t, [("max", TOP), ("min", BOTTOM)]), F.when(has_any(t, UP + DOWN), F.lit(None)).otherwise(F.coalesce(F.least(number, F.lit(100)).cast("string"), F.when(F.contains(t, F.lit("静音")), "0"))))
    adjustment = F.when(has_any(t, TOP + BOTTOM), "set").otherwise(F.coalesce(_pick(t, [("up", UP), ("down", DOWN)]), F.when(level.isNotNull(), "set")))
    slots = {
        "contact": F.when(rule == "call_manager", "property_manager").when(rule == "call_contact", F.coalesce(_pick(t, CONTACTS), F.when(~named.isin("我", "一下"), named))),
        "action": F.when(rule.isin("reject", "hangup"), rule).when(rule == "monitor_control", _pick(t, MONITOR)),
        "method": F.when(rule == "unlock", "remote"),
        "during_call": F.when((rule == "unlock") & F.contains(t, F.lit("通话")), "true"),
        "wallpaper_type": F.when(rule == "change_wallpaper", _which(t, WALLPAPERS)),
        "enabled": F.when(rule == "set_dnd", _pick(t, [("true", ON), ("false", OFF)])).when(rule == "set_security_mode", _pick(t, [("true", ARM), ("false", DISARM)])),
        "adjustment": F.when(is_level, adjustment),
        "level": F.when(is_level, level),
        "time_range": F.when(rule == "query_alarm_records", _which(t, RANGES)),
        "scene": F.when(rule == "monitor_control", _which(t, SCENES)),
        "channel": F.when(rule == "monitor_control", F.nullif(F.regexp_extract(t, r"(\d+)通道", 1), F.lit(""))),
        "message_type": F.when(rule == "view_messages", F.coalesce(_pick(t, [("sms", ["短信"]), ("notification", ["通知"])]), F.lit("all"))),
        "unread_only": F.when((rule == "view_messages") & has_any(t, ["新", "未读"]), "true"),
    }
    every = F.create_map(*[x for k, v in slots.items() for x in (F.lit(k), v.cast("string"))])
    needed = F.create_map(*[x for _, name, _, slot in CAPABILITIES if slot for x in (F.lit(name), F.lit(slot))])
    need = F.element_at(needed, F.coalesce(intent, F.lit("")))
    missing = F.when(need.isNotNull() & F.element_at(every, F.coalesce(need, F.lit(""))).isNull(), F.array(need)).otherwise(F.array().cast("array<string>"))
    dim = lambda i: F.element_at(F.create_map(*[x for c in CAPABILITIES for x in (F.lit(c[1]), F.lit(c[i]))]), F.coalesce(intent, F.lit("")))
    sure = F.coalesce(F.element_at(F.create_map(*[x for name, c, _ in RULES for x in (F.lit(name), F.lit(c))]), F.coalesce(rule, F.lit(""))), F.lit(0.0))
    return F.struct(
        dim(0).alias("capability_id"),
        dim(2).alias("capability"),
        intent.alias("intent"),
        F.map_filter(every, lambda _, v: v.isNotNull()).alias("slots"),
        missing.alias("missing_slots"),
        sure.alias("confidence"),
    )


def typed_slots(slots: Column) -> Column:
    """The slots of a label as a struct of their own types.

    A level is a number, or ``max`` or ``min`` in ``level_word``.
    """
    slot = lambda k: F.element_at(slots, F.lit(k))
    texts = ["contact", "action", "method", "wallpaper_type", "adjustment", "time_range", "scene", "message_type"]
    return F.struct(
        *[slot(k).alias(k) for k in texts],
        slot("level").try_cast("int").alias("level"),
        F.when(slot("level").isin("max", "min"), slot("level")).alias("level_word"),
        slot("channel").try_cast("int").alias("channel"),
        *[slot(k).try_cast("boolean").alias(k) for k in ("enabled", "during_call", "unread_only")],
    )

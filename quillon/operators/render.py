"""Texts made from templates: offline utterances, message lists for a model, and jobs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillon.operators.planning import cyclic_pick, uniform

# How a device command is worded, in English and in Chinese.
LEVELS = {"max": ("maximum", "最大"), "min": ("minimum", "最小"), "0": ("mute", "静音")}
STEPS = {
    ("set_volume", "up"): ("Turn the volume up.", "把声音调大一点。"),
    ("set_volume", "down"): ("Turn the volume down.", "把声音调低一点。"),
    ("set_brightness", "up"): ("Make the screen brighter.", "把屏幕调亮一点。"),
    ("set_brightness", "down"): ("Dim the screen.", "把屏幕调暗一点。"),
}
NOUNS = {"set_volume": ("volume", "音量"), "set_brightness": ("brightness", "亮度")}
ACTIONS = {"open": ("Open", "打开"), "close": ("Close", "关闭"), "view": ("View", "查看"), "playback": ("Play back", "回放"), "switch_channel": ("Switch", "切换")}
SCENES = {"front_door": ("front door", "门口"), "living_room": ("living room", "客厅"), "bedroom": ("bedroom", "卧室")}
WALLPAPERS = {"landscape": "风景", "default": "默认", "family": "家庭", "holiday": "节日", "cartoon": "卡通", "solid_color": "纯色", "dark": "深色", "light": "浅色"}
RANGES = {"today": "今天", "yesterday": "昨天", "the day before yesterday": "前天", "last week": "最近一周", "last three days": "最近三天", "this month": "这个月", "last month": "上个月"}
FALLBACK = ("Please handle this.", "请帮我处理一下。")


def _word(key: Column, table: dict, at: int | None, other: Column) -> Column:
    pairs = [F.lit(x) for k, v in table.items() for x in (k, v if at is None else v[at])]
    return F.coalesce(F.element_at(F.create_map(*pairs), F.coalesce(key, F.lit("\0"))), other)


def offline_utterance(template: Column, matched: Column, intent: Column, slots: Column, occurrence: Column, chinese: Column) -> Column:
    """A user's words for a label, without a model.

    ``template`` holds ``{wallpaper_type}``, ``{time_range}``, ``{action_text}``,
    ``{scene_text}`` and ``{channel_text}``, or is null.  Unmatched labels are the
    template as it is; others get one of three framings in turn.
    """
    slot = lambda k, default: F.coalesce(F.element_at(slots, F.lit(k)), F.lit(default))
    raw = lambda k: F.element_at(slots, F.lit(k))

    def worded(at: int) -> Column:
        step = F.coalesce(*[F.when((intent == i) & (raw("adjustment") == a), F.lit(v[at])) for (i, a), v in STEPS.items()])
        level = _word(raw("level"), LEVELS, at, F.coalesce(raw("level"), F.lit("None")))
        noun = _word(intent, NOUNS, at, F.lit(""))
        # The wordings of levels and channels in both languages.
        exact = F.concat(F.lit("Set the "), noun, F.lit(" to "), level, F.lit(".")) if at == 0 else F.concat(F.lit("把"), noun, F.lit("设为"), level, F.lit("。"))
        channel = slot("channel", "1")
        switch = F.concat(F.lit("Switch to channel "), channel, F.lit(".")) if at == 0 else F.concat(F.lit("切换到"), channel, F.lit("通道。"))
        scene = slot("scene", "front_door")
        wall = F.replace(slot("wallpaper_type", "landscape"), F.lit("_"), F.lit(" "))
        span = slot("time_range", "today")
        parts = {
            "wallpaper_type": wall if at == 0 else _word(raw("wallpaper_type"), WALLPAPERS, None, wall),
            "time_range": span if at == 0 else _word(span, RANGES, None, span),
            "action_text": _word(raw("action"), ACTIONS, at, F.lit(("View", "查看")[at])),
            "scene_text": _word(scene, SCENES, at, F.replace(scene, F.lit("_"), F.lit(" ")) if at == 0 else F.lit("门口")),
            "channel_text": channel,
        }
        filled = F.coalesce(template, F.lit(FALLBACK[at]))
        for k, v in parts.items():
            filled = F.replace(filled, F.lit("{" + k + "}"), v)
        levels = F.coalesce(intent.isin(*NOUNS), F.lit(False))
        switches = F.coalesce((intent == "monitor_control") & (raw("action") == "switch_channel"), F.lit(False))
        text = F.when(levels, F.coalesce(step, exact)).when(switches, switch).otherwise(filled)
        turn = F.pmod(occurrence, F.lit(3))
        # The framings in both languages.
        if at:
            framed = F.when(turn == 1, F.concat(F.lit("麻烦你"), text)).when(turn == 2, F.concat(F.regexp_replace(text, "。+$", ""), F.lit("，现在就弄。")))
        else:
            polite = F.concat(F.lit("Please, "), F.lower(F.left(text, F.lit(1))), F.substring(text, 2, 1 << 30))
            framed = F.when(turn == 1, polite).when(turn == 2, F.concat(F.regexp_replace(text, r"\.+$", ""), F.lit(" right now.")))
        return F.when(~matched, F.coalesce(template, F.lit(FALLBACK[at]))).otherwise(framed.otherwise(text))

    return F.when(chinese, worded(1)).otherwise(worded(0))


def message_list(system: str, shots: list[tuple[str, str]], user: Column) -> Column:
    """Messages for a model: a system text, examples as user and assistant turns, and the user's text."""
    turn = lambda role, text: F.struct(F.lit(role).alias("role"), text.alias("content"))
    fixed = [turn("system", F.lit(system))]
    for asked, answered in shots:
        fixed += [turn("user", F.lit(asked)), turn("assistant", F.lit(answered))]
    return F.array(*fixed, turn("user", user))


def filled(template: str, **values: Column) -> Column:
    """A template with ``{name}`` places filled; null values as ``None``."""
    out = F.lit(template)
    for name, value in values.items():
        out = F.replace(out, F.lit("{" + name + "}"), F.coalesce(value.cast("string"), F.lit("None")))
    return out


def temperature(key: Column, low: float = 0.75, high: float = 1.05, seed: int = 7) -> Column:
    """A sampling temperature between the bounds, drawn by the key."""
    return F.greatest(F.lit(low), F.least(F.lit(high), low + (high - low) * uniform(seed, key)))


def jobs(plan: DataFrame, languages: list[str], styles: list[str], contexts: list[str], seed: int = 7) -> DataFrame:
    """``plan`` (one row a job, with ``idx``, ``occurrence``, ``matched`` and ``missing_slots``) with ``style``,
    ``context``, ``language`` and ``temperature``; a label's own needs come before a drawn context."""
    shift = lambda n, salt: F.col("occurrence") + F.floor(uniform(seed + salt, F.col("idx")) * n)
    drawn = cyclic_pick(contexts, shift(len(contexts), 2))
    omit = F.concat(F.lit("must omit these slots: "), F.array_join("missing_slots", ", "))
    context = F.when(F.size("missing_slots") > 0, omit).when(~F.col("matched"), "must not express a device-control request").otherwise(drawn)
    return plan.select(
        "*", cyclic_pick(styles, shift(len(styles), 1)).alias("style"), context.alias("context"), cyclic_pick(languages, shift(len(languages), 3)).alias("language"), temperature(F.col("idx"), seed=seed + 4).alias("temperature")
    )

"""Words and shapes that decide what an order's own texts prove.

All functions are pure and look at one value; ``Texts`` wraps the four fields
of an order.
"""

from __future__ import annotations

import re

# --- fixed values: source fields; words that prove an intent, an emotion or satisfaction ---
FIELDS = ("case_content_clean", "title_clean", "case_goal_clean", "address_detail_clean")
INTENT_WORDS = {
    "投诉": ("投诉", "维权", "要求查处", "要求处罚", "请求查处", "请求处罚"),
    "举报": ("举报",),
    "求助": ("希望相关部门", "要求相关部门", "请求", "需要帮助", "希望", "要求"),
    "咨询": ("咨询", "如何", "怎么", "是否", "如何办理", "怎么办理", "办理流程", "需要准备什么", "需要哪些材料", "查询方式", "不清楚", "是否需要", "需向哪些部门", "核实是否"),
    "建议": ("建议",),
    "表扬": ("表扬",),
    "催办": ("催办", "再次要求", "仍未解决"),
    "反馈": ("反馈",),
}
LITERAL_WORDS = {"投诉": INTENT_WORDS["投诉"], "举报": ("举报",), "催办": ("催办",), "建议": ("建议",), "咨询": ("咨询",), "表扬": ("表扬",)}
WEAK_HELP = ("希望", "要求", "请求", "希望相关部门", "要求相关部门")
EMOTION_WORDS = {
    "愤怒": (("非常气愤", 3), ("十分气愤", 3), ("气愤", 2), ("愤怒", 2), ("生气", 2)),
    "不满": (("非常不满", 3), ("很不满意", 3), ("不满意", 2), ("其不认可", 2), ("不认可", 2)),
    "焦虑": (("非常着急", 3), ("十分着急", 3), ("焦虑", 2), ("着急", 2), ("担心", 1)),
    "无奈": (("非常无奈", 3), ("无奈", 2)),
    "悲伤": (("非常难过", 3), ("难过", 2), ("悲伤", 2)),
    "感谢": (("非常感谢", 3), ("感谢", 2), ("谢谢", 1)),
    "认可": (("非常认可", 3), ("认可", 2)),
}
UNASKED_EMOTIONS = ("愤怒", "不满", "焦虑", "无奈", "悲伤")
NOT_RECOGNISED = ("其不认可", "并不认可", "不认可", "未认可", "没有认可", "不能认可", "无法认可")
REQUESTERS = ("服务对象", "诉求人", "市民", "群众", "本人", "自己", "业主", "来电人", "反映人")
BRIDGE = re.compile(r"[，,。；;：:\s]*(?:对此|表示|感到|认为|觉得|很|非常|十分|相当|表示自己|对此表示)?[，,\s]*")
SATISFIED = ("满意", "认可处理结果", "认可答复")
DISSATISFIED = ("不是很满意", "不怎么满意", "不太满意", "满意度不高", "谈不上满意", "并不满意", "不满意", "其不认可", "并不认可", "不认可", "未认可", "没有认可", "不能认可", "无法认可", "有异议", "不接受答复")
OBJECT_ATTITUDES = ("工作人员态度恶劣", "商家态度恶劣", "客服态度恶劣", "服务态度恶劣", "态度恶劣", "服务态度差")

# --- fixed values: shapes of roads, intersections and places ---
ROAD_ENDS = ("路", "街", "大道", "巷", "弄", "线")
BARE_ROADS = ("马路", "道路", "公路")
ROAD_CONFLICTS = ("小区", "新村", "花园", "家园", "公园", "学校", "医院", "市场", "商场", "广场", "北门", "南门", "东门", "西门")
CROSSINGS = ("路口", "交叉口", "交界处", "交汇处")
POI_GAPS = ("小区", "新村", "花园", "学校", "幼儿园", "医院", "商场", "广场", "服务中心", "产业园", "工业园", "园区", "派出所", "超市", "体育馆", "学堂")
POI_WORDS = (
    "小区", "新村", "花园", "家园", "公园", "学校", "幼儿园", "医院", "市场", "商场", "广场", "服务中心", "有限公司", "公司", "工厂", "汽修厂", "店", "馆",
    "产业园", "工业园", "园区", "机构", "工作室", "派出所", "超市", "大厦", "华苑", "社区", "学堂", "体育馆", "北门", "南门", "东门", "西门",
)
POI_ENDS = ("苑", "城", "府", "村", "园", "中心", "公司", "厂", "店", "馆", "市场", "商场", "广场", "学校", "医院", "机构", "工作室", "派出所", "超市", "大厦", "社区", "学堂")
PLACES_NOT_ADMIN = ("小区", "园区", "景区", "校区", "社区", "厂区")
_W = r"[\u4e00-\u9fffA-Za-z0-9]"
ROAD_NAME = re.compile(_W + r"{1,16}?(?:大道|公路|道路|路|街|巷|弄|线)")
ROAD_WITH_TAIL = re.compile("(" + _W + r"{1,16}?(?:大道|公路|路|街|巷|弄|线))(?:方向|路段|沿线|附近|\d+(?:号|弄|栋|幢|单元)?)")
ROAD_JOINED = re.compile(r"(?:与|和|及|/|、).{0,8}?" + _W + r"{1,16}?(?:大道|公路|道路|路|街|巷|弄|线)")
ADMIN_AREA = re.compile(_W + r"{1,24}(?:省|市|区|县|镇|乡|街道)")
ROAD_ADDRESS = re.compile(_W + r"{1,24}(?:大道|公路|路|街|巷|弄)\d+(?:号|弄|栋|幢|单元)?")
CROSSING_TAIL = "(?:交叉口|路口|交叉处|交界处|交汇处)"

# --- fixed values: actions that are asked for, and what makes one a fact ---
REQUEST_ACTIONS = (
    "处理", "清理", "维修", "修剪", "拆除", "解决", "调查", "协调", "整改", "回复", "答复", "退款", "退费", "销课", "注销", "恢复", "核实", "查处",
    "处罚", "赔偿", "公示", "告知", "办理", "申请", "咨询", "查询", "注册", "转入", "就读", "了解",
)
SERVICE_ACTIONS = ("咨询", "查询", "办理", "注册", "申请", "转入", "就读", "了解")
SERVICE_STARTS = ("希望", "要求", "请求", "想要", "想", "需要", "咨询", "如何", "怎么", "是否")
REQUEST_MARKS = ("希望", "要求", "请求", "建议", "请", "督促", "协调", "何时", "如何", "怎么", "是否", "需要哪些", "需要什么")
FACT_STARTS = ("未", "没有", "尚未", "仍未", "一直未", "至今未", "还没有", "拒绝", "不予", "无法", "不能")
FACT_ENDS = ("未完成", "未到账", "失败", "受阻", "未通过", "不通过", "被拒")

# --- fixed values: relations whose target, and states whose support, evidence must hold ---
RELATIONS = ("严重影响", "影响", "妨碍", "遮挡", "堵塞", "占用", "损坏", "破坏", "污染", "拖欠")
STATES = {
    "过期": ("过期",), "变质": ("变质", "腐败"), "伪造": ("伪造", "作伪"), "假冒": ("假冒", "冒充"),
    "未整改": ("未整改", "没有整改", "未有任何整改", "尚未整改", "至今未有任何整改"),
    "未退款": ("未退款", "没有退款", "未退", "没有退", "尚未退", "未到账"),
    "未处理": ("未处理", "没有处理", "未予处理", "尚未处理", "无人处理", "不处理", "仍无处理"),
    "泄漏": ("泄漏", "漏气", "漏水"), "坍塌": ("坍塌", "倒塌"),
}

# --- fixed values: signs of a gap in the output and of history taken for news ---
ANOMALIES = (
    "盗用", "冒名", "拖欠", "破损", "损坏", "毁坏", "占用", "堵塞", "污染", "违法", "违规", "不立案", "不解答", "未处理", "未解决", "拒绝", "泄漏", "坍塌", "体罚",
    "诈骗", "无人", "未取得", "随地小便", "摆摊", "不清理", "不通过", "被拒", "三无", "态度不好",
)
HISTORY = ("部门答复", "处理结果", "前期反映", "原工单", "答复如下")
CURRENT = ("其不认可", "仍未解决", "现服务对象表示", "再次要求", "现再次反映")
SETTLED_SUMMARY, OPEN_SUMMARY = ("已处理", "已解决"), ("不认可", "仍未", "再次")


def has(text: str, words) -> bool:
    return any(w in text for w in words)


class Texts:
    """The four source fields of an order, missing ones empty."""

    def __init__(self, order: dict):
        self.by_field = {f: v if isinstance(v := order.get(f), str) else "" for f in FIELDS}
        self.joined = "".join(self.by_field.values())

    def __getitem__(self, field: str) -> str:
        return self.by_field.get(field, "")

    def field_with(self, text: str) -> str:
        """First field that literally holds ``text``, else empty."""
        return next((f for f, v in self.by_field.items() if text and text in v), "")

    def first_word(self, words) -> str:
        return next((w for w in words if self.field_with(w)), "")

    def has(self, words) -> bool:
        return has(self.joined, words)


# --- emotion and satisfaction ---
def owned(source: str, at: int, word: str) -> bool:
    """Whether the one who called is said to feel it: named shortly before, with at most a bridge between."""
    if word == "其不认可":
        return True
    before = source[max(0, at - 18) : at]
    tails = (before.rpartition(who)[2] for who in REQUESTERS if who in before)
    return any(len(tail) <= 8 and BRIDGE.fullmatch(tail) for tail in tails)


def emotion_in(texts: Texts, label: str) -> tuple[str, int]:
    """(word, intensity) of an emotion that the caller's text proves, else ("", 1)."""
    for word, level in EMOTION_WORDS.get(label, ()):
        for source in texts.by_field.values():
            for m in re.finditer(re.escape(word), source):
                denied = label == "认可" and source[: m.end()].endswith(tuple(n for n in NOT_RECOGNISED if n.endswith(word)) or ("\0",))
                if not denied and owned(source, m.start(), word):
                    return word, level
    return "", 1


def emotion_holds(texts: Texts, label: str, evidence: str) -> bool:
    return bool(has(evidence, [w for w, _ in EMOTION_WORDS.get(label, ())]) and texts.field_with(evidence) and emotion_in(texts, label)[0])


def intent_holds(label: str, evidence: str) -> bool:
    return bool(evidence) and (label == "其他" or has(evidence, INTENT_WORDS.get(label, ())))


def polarity(text: str) -> tuple[bool, bool]:
    """(satisfied, dissatisfied): what denies is taken out, longest first, before what affirms is sought."""
    rest = text
    for word in sorted(DISSATISFIED, key=len, reverse=True):
        rest = rest.replace(word, "")
    return has(rest, SATISFIED), has(text, DISSATISFIED)


def satisfaction_holds(label: str, evidence: str) -> bool:
    yes, no = polarity(evidence)
    return {"unknown": True, "mixed": yes and no, "satisfied": yes and not no, "dissatisfied": no and not yes}.get(label, False)


# --- shapes ---
def road_names(text: str) -> set[str]:
    return {found.lstrip("与和及") for found in ROAD_NAME.findall(text)} - {""}


def is_road(text: str) -> bool:
    """One named road and nothing of a place."""
    return text.endswith(ROAD_ENDS) and text not in BARE_ROADS and not has(text, ROAD_CONFLICTS) and len(road_names(text)) == 1


def road_of(*texts: str) -> str:
    """The road of the first text that is a road with a direction, a stretch or a house number."""
    found = (m[1] for t in texts if (m := ROAD_WITH_TAIL.fullmatch(t.strip())))
    return next(filter(is_road, found), "")


def is_crossing(text: str) -> bool:
    """Two roads or more and a word that relates them."""
    return len(road_names(text)) >= 2 and (has(text, CROSSINGS) or bool(ROAD_JOINED.search(text)))


def crossing_in(source: str, one: str, other: str) -> str:
    """Where ``source`` names the crossing of two roads, in either order, with a joining word or without."""
    for a, b in ((one, other), (other, one)):
        for joiner in (r"(?:与|和|及|/|、)\s*", ""):
            m = re.search(rf"{re.escape(a)}\s*{joiner}{re.escape(b)}{CROSSING_TAIL}", source)
            if m and is_crossing(m[0]):
                return m[0]
    return ""


def is_no_place(text: str) -> bool:
    """An administrative area or a bare road address, which is no place of interest."""
    text = text.strip()
    area = ADMIN_AREA.fullmatch(text) and not text.endswith(PLACES_NOT_ADMIN)
    return bool(text) and bool(area or ROAD_ADDRESS.fullmatch(text))


def fits_group(group: str, text: str) -> bool:
    """Whether a bare string has the shape of an entity group."""
    if group == "pois":
        return not is_no_place(text) and (has(text, POI_WORDS) or text.endswith(POI_ENDS))
    return {"roads": is_road, "intersections": is_crossing}.get(group, lambda _: True)(text)


# --- behaviours ---
def is_fact(evidence: str, actions) -> bool:
    """Whether an action is said not to have happened, or to have failed."""
    if any(start + act in evidence for act in actions for start in FACT_STARTS):
        return True
    ends = "|".join(map(re.escape, FACT_ENDS))
    return any(re.search(rf"{re.escape(act)}[^，,。；;]{{0,6}}?(?:{ends})", evidence) for act in actions)


def only_requested(texts: Texts, e: dict) -> bool:
    """A behaviour that is an action the caller asks for."""
    said = e["evidence"] or e["surface"] or e["canonical"]
    goal = e["source_field"] == "case_goal_clean" or bool(said) and said in texts["case_goal_clean"]
    actions = [w for w in REQUEST_ACTIONS if w in e["canonical"]]
    return bool(actions) and (goal or has(said, REQUEST_MARKS)) and not is_fact(e["evidence"], actions)


def is_service(e: dict) -> bool:
    """A behaviour that is an ordinary service, used or asked about."""
    actions = [w for w in SERVICE_ACTIONS if w in " ".join((e["evidence"], e["surface"], e["canonical"]))]
    if not actions or is_fact(e["evidence"], actions):
        return False
    named = (e["canonical"] or e["surface"] or e["evidence"]).strip()
    return named.startswith(SERVICE_ACTIONS) or e["evidence"].strip().startswith(SERVICE_STARTS) and has(e["evidence"], actions)


def name_conflicts(e: dict) -> bool:
    """A canonical name that shares no character with its evidence, or claims a target or state it lacks."""
    name, said = e["canonical"], e["surface"] + e["evidence"]
    if not name or not e["evidence"]:
        return False
    strange = len(name) > 2 and not set(name) & set(said)
    targets = (name[len(r) :].strip() for r in RELATIONS if name.startswith(r))
    missed = any(len(t) >= 2 and t not in said for t in targets)
    return strange or missed or any(state in name and not has(said, support) for state, support in STATES.items())

"""Streaming twins of the detection operators, as rules over ordered events."""

from __future__ import annotations

from tidemark.operators.automaton import TERMINAL, TRANSITIONS
from tidemark.operators.detection import NO_CREATE, PAID, PAID_LATE, UNPAID
from tidemark.streaming.ordered import Rule

EVENT = (("pos", "long"), ("event_id", "long"), ("event_type", "string"))
READING = (("pos", "long"), ("event_id", "long"), ("value", "long"))


class StateMachine(Rule):
    """Alert on an event that is illegal in the key's state."""

    fields = EVENT
    memo = (("state", "string"),)
    output = (("event_id", "long"), ("event", "string"), ("state", "string"))

    def on_event(self, memo, row):
        state = memo["state"] or "Initial"
        to = TRANSITIONS.get((state, row["event_type"]))
        if to is None:
            return [(row["event_id"], row["event_type"], state)]
        memo["state"] = None if to == TERMINAL else to
        return []


class PaymentTimeout(Rule):
    """Create and pay of one order; a newer create replaces a waiting one."""

    fields = EVENT
    memo = (("created", "long"), ("created_id", "long"))
    output = (("event_id", "long"), ("outcome", "string"))

    def __init__(self, create: str, pay: str, within: int):
        self.create, self.pay, self.within = create, pay, within

    def on_event(self, memo, row):
        if row["event_type"] == self.create:
            memo["created"], memo["created_id"] = row["pos"], row["event_id"]
        elif row["event_type"] == self.pay:
            if memo["created"] is None:
                return [(row["event_id"], NO_CREATE)]
            in_time = row["pos"] < memo["created"] + self.within
            found = [(memo["created_id"], PAID if in_time else PAID_LATE)]
            memo["created"] = memo["created_id"] = None
            return found
        return []

    def due(self, memo):
        return None if memo["created"] is None else memo["created"] + self.within

    def on_timer(self, memo, at):
        waited = memo["created_id"]
        memo["created"] = memo["created_id"] = None
        return [(waited, UNPAID)]


class FailTimer(Rule):
    """Count failures collected when the timer of a failure goes off."""

    fields = EVENT
    memo = (("fails", "long"), ("timers", "array<long>"), ("ids", "array<long>"))
    output = (("event_id", "long"), ("fails", "long"), ("alert_pos", "long"))

    def __init__(self, fail: str, clear: str, wait: int, at_least: int = 2):
        self.fail, self.clear, self.wait, self.at_least = fail, clear, wait, at_least

    def start(self):
        return {"fails": 0, "timers": [], "ids": []}

    def on_event(self, memo, row):
        if row["event_type"] == self.fail:
            memo["fails"] += 1
            memo["timers"] = [*memo["timers"], row["pos"] + self.wait]
            memo["ids"] = [*memo["ids"], row["event_id"]]
        elif row["event_type"] == self.clear:
            memo["fails"] = 0
        return []

    def due(self, memo):
        return memo["timers"][0] if len(memo["timers"]) else None

    def on_timer(self, memo, at):
        found = [(memo["ids"][0], memo["fails"], at)] if memo["fails"] >= self.at_least else []
        memo["timers"], memo["ids"], memo["fails"] = memo["timers"][1:], memo["ids"][1:], 0
        return found


class Offline(Rule):
    """Repeat an alert until the next message after an offline message."""

    fields = EVENT
    memo = (("since_id", "long"), ("due", "long"), ("alert_no", "long"))
    output = (("event_id", "long"), ("alert_no", "long"), ("alert_pos", "long"))

    def __init__(self, offline: str, every: int):
        self.offline, self.every = offline, every

    def on_event(self, memo, row):
        off = row["event_type"] == self.offline
        memo["since_id"] = row["event_id"] if off else None
        memo["due"] = row["pos"] + self.every if off else None
        memo["alert_no"] = 0
        return []

    def due(self, memo):
        return memo["due"]

    def on_timer(self, memo, at):
        memo["alert_no"] += 1
        memo["due"] = at + self.every
        return [(memo["since_id"], memo["alert_no"], at)]


class RisingTrend(Rule):
    """Alert when a value has not decreased for a while after it began to rise."""

    fields = READING
    memo = (("last", "long"), ("started", "long"))
    output = (("rise_pos", "long"), ("alert_pos", "long"))

    def __init__(self, hold: int):
        self.hold = hold

    def on_event(self, memo, row):
        before, memo["last"] = memo["last"], row["value"]
        if before is None or before == 0 or before > row["value"]:
            memo["started"] = None
        elif before < row["value"] and memo["started"] is None:
            memo["started"] = row["pos"]
        return []

    def due(self, memo):
        return None if memo["started"] is None else memo["started"] + self.hold

    def on_timer(self, memo, at):
        found = [(memo["started"], at)]
        memo["started"] = None
        return found


class ValueJump(Rule):
    """Alert when a value differs from the previous one by more than a threshold."""

    fields = READING
    memo = (("last", "long"),)
    output = (("event_id", "long"), ("prev_value", "long"), ("value", "long"))

    def __init__(self, threshold: int):
        self.threshold = threshold

    def on_event(self, memo, row):
        before, memo["last"] = memo["last"], row["value"]
        if before and abs(before - row["value"]) > self.threshold:
            return [(row["event_id"], before, row["value"])]
        return []


class Blacklist(Rule):
    """Pass the first rows of a day, warn once, drop the rest; a new day starts afresh."""

    fields = EVENT
    memo = (("day", "long"), ("seen", "long"))
    output = (("event_id", "long"), ("verdict", "string"))

    def __init__(self, max_count: int, day: int = 86_400_000_000):
        self.max_count, self.day = max_count, day

    def on_event(self, memo, row):
        day = row["pos"] // self.day
        memo["seen"] = 1 if day != memo["day"] else memo["seen"] + 1
        memo["day"] = day
        if memo["seen"] <= self.max_count:
            return [(row["event_id"], "pass")]
        return [(row["event_id"], "warn")] if memo["seen"] == self.max_count + 1 else []


class Changelog(Rule):
    """Running count as a retract log."""

    fields = EVENT
    memo = (("n", "long"),)
    output = (("event_id", "long"), ("op", "string"), ("cnt", "long"))

    def start(self):
        return {"n": 0}

    def on_event(self, memo, row):
        memo["n"] += 1
        add = (row["event_id"], "+", memo["n"])
        return [(row["event_id"], "-", memo["n"] - 1), add] if memo["n"] > 1 else [add]


class MatchStreams(Rule):
    """Pair the records of two tagged sources, or report the one that waited in vain."""

    fields = EVENT  # event_type holds the side: left or right
    memo = (("side", "string"), ("pos", "long"), ("id", "long"))
    output = (("left_id", "long"), ("right_id", "long"), ("status", "string"))

    def __init__(self, timeout: int):
        self.timeout = timeout

    def _alone(self, memo):
        if memo["side"] == "left":
            return (memo["id"], None, "only_left")
        return (None, memo["id"], "only_right")

    def on_event(self, memo, row):
        side = row["event_type"]
        if memo["side"] is None:
            memo.update(side=side, pos=row["pos"], id=row["event_id"])
            return []
        if memo["side"] == side:  # two of one kind: the older one gave up its place
            found = [self._alone(memo)]
            memo.update(side=side, pos=row["pos"], id=row["event_id"])
            return found
        pair = {side: row["event_id"], memo["side"]: memo["id"]}
        memo.update(side=None, pos=None, id=None)
        return [(pair["left"], pair["right"], "matched")]

    def due(self, memo):
        return None if memo["side"] is None else memo["pos"] + self.timeout

    def on_timer(self, memo, at):
        found = [self._alone(memo)]
        memo.update(side=None, pos=None, id=None)
        return found


class DeltaTrigger(Rule):
    """Fire when progress has grown enough; report the largest recent measure."""

    fields = (("pos", "long"), ("event_id", "long"), ("progress", "long"), ("measure", "long"))
    # Recent rows as three parallel lists: position, id, measure.
    memo = (("base", "long"), ("at", "array<long>"), ("ids", "array<long>"), ("measures", "array<long>"))
    output = (("event_id", "long"), ("progress", "long"), ("best_event_id", "long"), ("best", "long"))

    def __init__(self, threshold: int, last: int):
        self.threshold, self.last = threshold, last

    def start(self):
        return {"base": None, "at": [], "ids": [], "measures": []}

    def on_event(self, memo, row):
        recent = [r for r in zip(memo["at"], memo["ids"], memo["measures"]) if r[0] > row["pos"] - self.last]
        recent.append((row["pos"], row["event_id"], row["measure"]))
        memo["at"], memo["ids"], memo["measures"] = (list(column) for column in zip(*recent))
        if memo["base"] is None:
            memo["base"] = row["progress"]
            return []
        if row["progress"] - memo["base"] <= self.threshold:
            return []
        memo["base"] = row["progress"]
        best = max(recent, key=lambda r: (r[2], -r[0], -r[1]))
        return [(row["event_id"], row["progress"], best[1], best[2])]


class LatestModel(Rule):
    """Tag each data row with the newest model row before it (``event_type`` ``model`` marks models)."""

    fields = (("pos", "long"), ("event_id", "long"), ("event_type", "string"), ("value", "long"))
    memo = (("model_id", "long"), ("model", "long"))
    output = (("event_id", "long"), ("model_id", "long"), ("model", "long"))

    def on_event(self, memo, row):
        if row["event_type"] == "model":
            memo["model_id"], memo["model"] = row["event_id"], row["value"]
            return []
        return [(row["event_id"], memo["model_id"], memo["model"])]


class CountWindow(Rule):
    """Emit count and sum of every ``n`` rows of a key; an incomplete window stays open."""

    fields = READING
    memo = (("n", "long"), ("total", "long"), ("window_no", "long"))
    output = (("window_no", "long"), ("total", "long"), ("last_event_id", "long"))

    def __init__(self, n: int):
        self.n = n

    def start(self):
        return {"n": 0, "total": 0, "window_no": 0}

    def on_event(self, memo, row):
        memo["n"], memo["total"] = memo["n"] + 1, memo["total"] + row["value"]
        if memo["n"] < self.n:
            return []
        found = [(memo["window_no"], memo["total"], row["event_id"])]
        memo.update(n=0, total=0, window_no=memo["window_no"] + 1)
        return found
